import math
import random
from collections import Counter

import numpy as np
import pytest

from tallyfold.llm import lexical_search
from tallyfold.llm.queries import ORACLES, QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents
from verification.compare import connect


def plain_terms(text):
    out = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text or "")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in out).split(" ")


def plain(docs, items, k=10):
    """{item number: [(rank, doc_id, score)]} by the definition."""
    counted = [Counter(t for t in plain_terms(text) if t) for _, text in docs]
    size = [sum(c.values()) for c in counted]
    n_docs, n_terms = sum(s > 0 for s in size), sum(size)
    held = Counter(t for c in counted for t in c)
    out = {}
    for number, (_, text) in enumerate(items):
        found = []
        for (doc_id, _), n, counts in zip(docs, size, counted):
            score = 0
            for t in {t for t in plain_terms(text) if t} & set(counts):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                m = 10 + 90 * n * n_docs // n_terms
                score += weight * (10 ** 9 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out[number] = [(rank + 1, None if none else d, -s)
                       for rank, (s, none, d) in enumerate(sorted(found)[:k])]
    return out


def check(spark, docs, items, k=10):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.ranked_search(frame, asked, k=k).collect()
    want = plain(docs, items, k)
    rows = sorted(str((items[i][0], *r)) for i, found in want.items() for r in found)
    assert sorted(str(tuple(r)) for r in got) == rows
    return rows


def random_texts(rng, n, words=40):
    return [" ".join(f"t{int(rng.paretovariate(0.7)) % words}" for _ in range(rng.randrange(30)))
            for _ in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_search_equals_the_definition(spark, monkeypatch, block_bytes):
    rng = random.Random(3)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lexical_search, "CELLS", 700)
    monkeypatch.setattr(lexical_search, "KEPT_ROWS", 20)
    docs = list(enumerate(random_texts(rng, 180)))
    docs += [(1000 + i, docs[3][1]) for i in range(60)]   # ties, a third of all rows
    assert check(spark, docs, list(enumerate(random_texts(rng, 25))), 7)


@pytest.mark.parametrize("seed", range(5))
def test_shared_sums(seed):
    rng = random.Random(seed)
    common = rng.sample(range(60), 20)
    items = [set(rng.sample(common, rng.randrange(15))) | {rng.randrange(60) for _ in range(5)}
             for _ in range(20)] + [set(), set(common), set(common)]
    graph = lexical_search.SharedSums(items, 60)
    values = np.random.default_rng(seed).integers(0, 99, (60, 7))
    values[sorted(set(range(60)) - set().union(*items))] = 0  # a block numbers its items' terms
    term, doc = np.nonzero(values)
    got = graph.scores(term, doc, values[term, doc], 7)
    want = np.array([values[sorted(item)].sum(axis=0) for item in items])
    assert (got == want).all()
    sums = sum(len(left) for left, _ in graph.levels)
    assert sums < sum(len(item) - 1 for item in items if item)  # what is shared is summed once
    assert graph.item_nodes[-1] == graph.item_nodes[-2]


def test_awkward_rows(spark):
    texts = [*AWKWARD, "Aa-aA bB", "ÉÉ é", "x_y 12z", "same TEXT"]
    frame = documents(spark, texts, first=50)
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    items = [(1, "same text twice aa bb"), (2, None), (3, ""), (1, "é 12z y lorem 42 a"),
             (None, "lorem lorem"), (5, "none_of_these")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "*", "1 AS rank", "'x' AS score", "2 AS doc_id")
    got = lexical_search.ranked_search(frame, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = [(items[i][0], *r) for i, found in plain(rows, items).items() for r in found]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    assert lexical_search.ranked_search(no_documents(spark), asked).count() == 0
    assert lexical_search.ranked_search(frame, asked.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op12_ranked_lexical_search"
    got = QUERIES[name](spark, sf_dir)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = connect(sf_dir).execute(ORACLES[name]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
