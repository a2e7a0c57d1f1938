import hashlib
import random
import re

import numpy as np
import pytest

from tallyfold.llm import decontaminate
from tallyfold.llm.queries import ORACLES, QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents, texts
from verification.compare import connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width=13):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    out = []
    for text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((len(w), len(hit), len(ids), digest, 0 < len(hit) and 20 * len(hit) >= len(w)))
    return out


def judged(spark, docs, items, **options):
    frame = docs if not isinstance(docs, list) else spark.createDataFrame(
        list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.verdicts(frame, bench, **options).collect()
    return [tuple(r[-1])[:5] for r in (rows if not isinstance(docs, list) else sorted(rows))]


@pytest.mark.parametrize("options", [{}, {"block_words": 10}, {"shard_bytes": 64}])
def test_small_alphabets(spark, options):
    rng = random.Random(5)
    some = ["a", "b", "C", "É", "x" * 17, "ABCDEFGH", "12"]
    items = [(i, " ".join(rng.choices(some, k=rng.randint(0, 8)))) for i in range(12)]
    docs = [" , ".join(rng.choices([*some, "zz"], k=rng.randint(0, 60))) for _ in range(40)]
    assert judged(spark, docs, items, window=4, **options) == brute(docs, items, 4)


def test_suffix_array_is_sorted_and_whole():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 400):
        ids = rng.integers(0, 5, n)
        cut = lambda i: tuple(next(([*ids[i:k]] for k in range(i, n) if ids[k] < 2), ids[i:]))
        order = decontaminate.suffix_array(ids, 400).tolist()
        assert sorted(order) == np.flatnonzero(ids > 1).tolist()
        assert [cut(i) for i in order] == sorted(cut(i) for i in order)


def test_longest_matches(spark):
    item = "one two three four five six seven"
    docs = [f"x {item} y", "x two three four z", "nothing here"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    row = min(decontaminate.occurrences(frame, bench).collect()).found[0]
    assert (row.longest, row.longest_item, row.longest_item_start, row.longest_start) == (7, "9", 0, 1)
    assert [tuple(h) for h in row.hits] == [(1, 8)]


def longest_of(doc, items):
    """(length, start) of the first longest match, the plain way."""
    w = words(doc)
    runs = {tuple(x[a:b]) for x in (words(t) for _, t in items)
            for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
    return max(((n, -k) for k in range(len(w)) for n in range(1, len(w) - k + 1)
                if tuple(w[k:k + n]) in runs), default=(0, None))


@pytest.mark.parametrize("short", [2, decontaminate.LONG_MATCH])
@pytest.mark.parametrize("shard_bytes", [64, 1 << 20])
def test_longest_match_of_every_document_of_a_shard(monkeypatch, short, shard_bytes):
    monkeypatch.setattr(decontaminate, "LONG_MATCH", short)
    monkeypatch.setattr(decontaminate, "STRIDE", 3)
    rng = random.Random(9)
    passage = " ".join(rng.choices("one two three four five six".split(), k=90))
    items = [(i, " ".join(rng.choices("abcd", k=rng.randint(0, 9)))) for i in range(8)]
    items += [(8, "one two three four five six seven"), (9, passage), (10, passage)]
    docs = ["x one two three four five six seven y", "x two three four z", "nothing here", "",
            "two three four", "one two three four five six seven", f"x {passage}", passage,
            f"{passage[20:]} {passage}", passage[:150]]
    docs += [" ".join(rng.choices("abcdz", k=rng.randint(0, 30))) for _ in range(30)]
    block = decontaminate.Block.of([(str(i), t) for i, t in items], 13)
    rows, held = [], []
    for doc in docs:
        held.append(doc)
        if sum(map(len, held)) >= shard_bytes or doc is docs[-1]:
            rows += block.search(held)
            held = []
    texts_ = {str(i): words(t) for i, t in items}
    for doc, (_, _, _, n, item, item_start, start) in zip(docs, rows, strict=True):
        length, first = longest_of(doc, items)
        assert (n, start) == (length, None if first is None else -first)
        assert not n or words(doc)[start:start + n] == texts_[item][item_start:item_start + n]


def test_awkward_rows(spark):
    items = [(1, "same text twice"), (1, "text twice same"), (None, "id"), (2, None), (3, ""),
             (4, "ÜNÏcödé"), (5, " ".join(["lorem ipsum dolor 42"] * 30))]
    frame = documents(spark, AWKWARD)
    given = frame.collect()
    assert sorted(judged(spark, frame, items)) == sorted(brute([r.text for r in given], items))
    kept = decontaminate.decontaminated(frame, spark.createDataFrame(
        items, "item_id long, text string"))
    assert kept.columns == frame.columns
    assert kept.count() == sum(not b[4] for b in brute([r.text for r in given], items))
    assert judged(spark, AWKWARD, items[:0] or [(1, None)]) == brute(AWKWARD, [(1, None)])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminated(frame, empty).count() == len(given)
    assert decontaminate.verdicts(no_documents(spark), empty).count() == 0


def test_blocks_one_after_another(spark):
    items = [(i, f"{'same text' if i % 2 else 'other words'} twice {i}") for i in range(4)]
    frame = documents(spark, AWKWARD)
    whole, blocks = (decontaminate.verdicts(frame, spark.createDataFrame(
        items, "item_id long, text string"), window=2, block_words=n) for n in (1000, 5))
    assert blocks.columns == whole.columns and blocks.columns[:-1] == frame.columns

    def rows(judged):
        return sorted(str((*r[:-1], *r[-1][:5])) for r in judged.collect())

    assert rows(blocks) == rows(whole)


def test_query_equals_brute_force(spark):
    import duckdb

    sf_dir = "/root/testdata/sf0.001"
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    given = texts(sf_dir)
    found = QUERIES["op9_decontamination"](spark, sf_dir).collect()
    got = {r.doc_id: tuple(r)[1:6] for r in found}
    matches = {r.doc_id: (r.longest, r.longest_start) for r in found}
    runs = connect(sf_dir).execute(ORACLES["op9_decontamination"]).fetchall()
    assert matches == {r[0]: tuple(r)[6:] for r in runs}
    assert got == {d: row for (d, _), row in zip(given, brute([t for _, t in given], items))}
    assert any(r[4] for r in got.values())


@pytest.mark.parametrize("block_words", [10 ** 6, 12])
def test_verdicts_locate_the_longest_match(spark, block_words):
    """Over one block and over many: the first longest match of a document, and an item that holds it."""
    rng = np.random.default_rng(8)
    items = [(str(i), " ".join(rng.choice(list("abcde"), rng.integers(1, 15)))) for i in range(12)]
    docs = [" ".join(rng.choice(list("abcdexyz"), rng.integers(0, 40))) for _ in range(60)] + [
        items[3][1], f"x {items[5][1]} y {items[5][1]}", "z z", ""]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    texts_ = dict(items)
    for row in decontaminate.verdicts(frame, asked, block_words=block_words).collect():
        v, words = row.verdict, row.text.split()
        length, before = longest_of(row.text, items)
        start = -before if length else None
        assert (v.longest, v.longest_start) == (length, start)
        if length:
            held = texts_[v.longest_item].split()
            at = v.longest_item_start
            assert held[at:at + length] == words[start:start + length]
        else:
            assert v.longest_item is None and v.longest_item_start is None
