import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyfold.llm import toxicity
from tallyfold.llm.queries import QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents

LABELS = "doc_id long, toxic int, quality int"


def corpus(spark, n=600):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, 60))
        if i % 5 == 0:
            text[10:12] = ["vile", "brute"]
        rows.append((i, " ".join(text)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame([(i, int(i % 5 == 0), 1) for i, _ in rows], LABELS))


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(spark)
    got = docs.select("doc_id", "text")
    rows = toxicity.scored(got, labels).select("doc_id", "toxicity.*").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(b"%d" % i) % 4 == 2}
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    right = sum(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert right >= 0.95 * len(held)


def test_held_out_labels_and_clashing_columns_do_not_matter(spark):
    docs, labels = corpus(spark, 200)
    turned = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - toxic,"
                               " toxic) AS toxic", "quality")
    one, two = (sorted(toxicity.scored(d, x).selectExpr("doc_id", "toxicity.score").collect())
                for d, x in ((docs, labels), (docs.selectExpr("*", "1 AS label", "2 AS place"),
                                              turned)))
    assert one == two


def test_sample_bound_ties_and_bad_labels(spark):
    docs, labels = corpus(spark, 100)
    odd = labels.union(spark.createDataFrame([(1, None, 1), (None, 1, 1), (2, 1, 0), (2, 0, 0),
                                              (9999, 1, 1)], LABELS))
    rows = toxicity.training_rows(docs, odd, "doc_id", F.lit(False), 20).collect()
    assert len(rows) <= 20
    every = {r.id: r.label for r in toxicity.training_rows(
        docs, odd, "doc_id", F.lit(False), 1000).collect()}
    assert every[2] == 1 and len(every) == 100


def test_awkward_rows(spark):
    _, labels = corpus(spark, 50)
    frame = documents(spark, AWKWARD)
    got = toxicity.scored(frame, labels)
    assert got.columns == [*frame.columns, "toxicity"]
    rows = got.collect()
    assert len(rows) == len(AWKWARD) + 2
    assert all(0 <= r.toxicity.score <= 1 for r in rows)
    same = [r.toxicity.score for r in rows if r.text == "same text twice"]
    assert same[0] == same[1]
    none = toxicity.scored(frame, labels.where("false"))
    assert {r.toxicity.score for r in none.collect()} == {0.0}
    assert toxicity.not_toxic(frame, labels).columns == frame.columns
    assert toxicity.scored(no_documents(spark), labels).count() == 0


def test_features_are_those_of_the_plain_way():
    texts = ["a b c a b", "", "c", "a b"]
    text, bucket = toxicity.features(texts, 20)
    assert [int((text == i).sum()) for i in range(4)] == [9, 0, 1, 3]  # 3 words, 3 pairs, 3 skips
    stems = [set(toxicity.features([t], 20)[1].tolist()) for t in ("stupid", "stupidly", "stupi")]
    assert [len(s) for s in stems] == [2, 2, 1] and stems[0] & stems[1] == stems[2]
    alone = [set(toxicity.features([t], 20)[1].tolist()) for t in texts]
    assert alone == [set(bucket[text == i].tolist()) for i in range(4)]
    assert alone[3] < alone[0] and alone[2] < alone[0]


def test_query_covers_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = QUERIES["op6_toxicity"](spark, sf_dir).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)


def plain_ftrl(rows, size, l1, alpha=1.0, beta=1.0, l2=1.0, epochs=2):
    """Weights coordinate by coordinate, by the published update."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for label, at in rows:
            w = {int(i): weight(int(i)) for i in at}
            gradient = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in w:
                rate = (math.sqrt(n[i] + gradient ** 2) - math.sqrt(n[i])) / alpha
                z[i] += gradient - rate * w[i]
                n[i] += gradient ** 2
    return [weight(i) for i in range(size + 1)]


def test_learning_equals_the_plain_updates():
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < 0.4), np.append(rng.choice(64, 9, replace=False), 64))
            for _ in range(200)]
    for l1 in (0.0, 0.5, 3.0):
        got, want = toxicity.fit(rows, 6, l1), plain_ftrl(rows, 64, l1)
        assert np.allclose(got, want, rtol=1e-12, atol=1e-12)
        assert ((got == 0) == (np.array(want) == 0)).all()


def test_the_strength_is_chosen_by_folds():
    rng = np.random.default_rng(5)
    noise = [(int(rng.random() < 0.1), np.append(rng.choice(1024, 40), 1024)) for _ in range(120)]
    assert toxicity.chosen_strength(noise, 10, (0.01, 8.0)) == 8.0
    clear = [(y, np.append(rng.choice(1023, 5), [1023] * int(y) + [1024])) for y in rng.integers(0, 2, 120)]
    assert toxicity.chosen_strength(clear, 10, (0.5, 40.0)) == 0.5


def test_bound_of_the_features(spark):
    docs, labels = corpus(spark, 60)
    rows = toxicity.training_rows(docs, labels, "doc_id", F.lit(False), 100)
    assert len(toxicity.train(rows, max_features=10)[0]) == 0  # no row fits
    every, some = (toxicity.train(rows, l1=0.1, max_features=n) for n in (1 << 30, 3_000))
    assert 0 < len(some[0]) < len(every[0])


def test_another_text_column_beside_one_named_text(spark):
    docs, labels = corpus(spark, 80)
    both = docs.selectExpr("doc_id", "text AS said", "'other' AS text")
    one, two = (sorted(toxicity.scored(d, labels, text=name).selectExpr(
        "doc_id", "toxicity.score").collect()) for d, name in ((docs, "text"), (both, "said")))
    assert one == two


def test_recall_on_the_given_held_out_labels(spark):
    """Of the labelled toxic documents that no training row saw; clean ones are left alone."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    rows = QUERIES["op6_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").where(
        "toxic IS NOT NULL").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0]
