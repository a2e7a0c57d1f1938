import __spark_entry__ as contract
import corpus_pipeline
from tallyfold.llm import secrets
from tests.llm.samples import AWKWARD, texts
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_secrets import ENCODING
from tests.llm.test_sentencepiece import MODEL, plain
from tests.llm.test_simhash import plain_groups, plain_print

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = contract.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in names
                  if n.startswith("op") and n[2].isdigit()) == [*range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan",
        "sentencepiece"]


def test_run_equals_brute_force_after_the_classifier(spark):
    import duckdb
    import sentencepiece

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF_DIR).collect()}
    given = [(d, t) for d, t in texts(SF_DIR) if d in clean]
    roots = plain_groups([plain_print(t) for _, t in given])
    given = [given[i] for i in sorted(set(roots))]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    judged = contamination([t for _, t in given], items)
    given = [row for row, verdict in zip(given, judged) if not verdict[4]]
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    want = {d: plain(library, secrets.masked(t, secrets.all_spans(t, ENCODING), "[SECRET]"))
            for d, t in given}
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want
    assert 0 < len(want) < len(texts(SF_DIR))


def test_stages_keep_columns_and_awkward_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, toxicity string"
    rows = [(i, t, "en", "s", 0, "x") for i, t in enumerate(AWKWARD)] + [(None, None, None, None,
                                                                          None, None)] * 2
    for frame in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, frame, SF_DIR)
            if name != "sentencepiece":
                assert after.schema.names == frame.schema.names
            after.collect()
