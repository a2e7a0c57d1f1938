import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import simhash
from tallyfold.llm.components import connected
from tallyfold.llm.queries import QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents, texts


def plain_print(text, k=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    words = [w for w in lower.split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    """Least index reachable, by depth-first search over all pairs."""
    root = [None] * len(prints)
    codes = np.array(prints, np.uint64)
    for i in range(len(prints)):
        if root[i] is None:
            todo, root[i] = [i], i
            while todo:
                for k in np.flatnonzero(np.bitwise_count(codes ^ codes[todo.pop()]) <= radius):
                    if root[k] is None:
                        root[k] = i
                        todo.append(k)
    return root


def test_fingerprints():
    for text in [*AWKWARD, "A B c", "one two three four", "a\x0bb\x0cc\xa0d e", "É é Ω"]:
        assert simhash.fingerprint(text or "") == plain_print(text)
    assert simhash.fingerprint("") == 0


@pytest.mark.parametrize("tile", [1, 3, 64])
def test_links_connect_what_all_pairs_connect(tile):
    rng = np.random.default_rng(tile)
    base = rng.integers(0, 2 ** 63, 40).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (5, 40)).astype(np.uint64)
    codes = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[1] ^ flips[2],
                                      base ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3] ^ flips[4]]))
    want = plain_groups(codes.tolist(), 3)
    left, right = codes[::2], codes[1::2]
    found = [simhash.links(left, None, 3, tile), simhash.links(right, None, 3, tile),
             simhash.links(left, right, 3, tile)]
    assert all(len(f) < len(codes) for f in found)
    place = {c: i for i, c in enumerate(codes.tolist())}
    root = list(range(len(codes)))
    for _ in range(len(codes)):
        for a, b in np.concatenate(found).tolist():
            root[place[a]] = root[place[b]] = min(root[place[a]], root[place[b]])
    assert root == want


def test_connected_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1), (21, 20)] + [
        (100 + i, 101 + i) for i in range(60)] + [(1000, 2000 + i) for i in range(50)]
    frame = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in connected(frame).collect()}
    want = {4: 3, 5: 3, 9: 3, 21: 20} | {101 + i: 100 for i in range(60)} | {
        2000 + i: 1000 for i in range(50)}
    assert got == want
    assert connected(frame.where("false")).count() == 0


def test_awkward_rows(spark):
    frame = documents(spark, AWKWARD, first=50)
    got = simhash.near_duplicates(frame).collect()
    rows = frame.select("doc_id", "text").collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id))
    roots = plain_groups([plain_print(rows[i].text) for i in order])
    want = sorted(str((rows[i].doc_id, rows[order[r]].doc_id)) for i, r in zip(order, roots))
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == want
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len(set(roots))
    assert kept.where("text = 'no id'").count() == 1
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    assert simhash.one_of_each(no_documents(spark)).count() == 0


def test_groups_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    codes = (rng.integers(0, 2 ** 12, 900).astype(np.uint64) << np.uint64(40)).view(np.int64)
    prints = spark.createDataFrame([(i, c) for i, c in enumerate(codes.tolist())],
                                   "doc_id long, fingerprint long")
    results = []
    for size in (10_000, 100):
        monkeypatch.setattr(simhash, "BLOCKS", (size, 32, 1 << 20))
        results.append(sorted(map(tuple, simhash.groups(prints, F.col("doc_id"), 1).collect())))
    assert results[0] == results[1]


@pytest.mark.parametrize("size,radius", [(1, 0), (5, 3), (40, 4), (10 ** 6, 4)])
def test_codes_are_dealt_by_bit_count(size, radius):
    rng = np.random.default_rng(size)
    counts = {int(b): int(n) for b, n in zip(*np.unique(rng.binomial(64, 0.5, 300),
                                                        return_counts=True))}
    places = simhash.deal_by_bits(counts, size, radius)
    assert len(places) == 65
    for a, (first, n, low, high) in enumerate(places):
        assert low <= first and first + n - 1 <= high
        assert counts.get(a, 0) <= n * size
        for b, (other, m, _, _) in enumerate(places):
            if abs(a - b) <= radius:
                assert low <= other and other + m - 1 <= high
    if size == 5:  # far bit counts don't meet
        assert places[24][3] < places[40][0]


def test_fewer_rows_are_dealt(spark, monkeypatch):
    """Links are those of all pairs, though each code meets only blocks of near bit counts."""
    rng = np.random.default_rng(9)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 300)
    near = base ^ (1 << rng.integers(0, 63, 300)) ^ (1 << rng.integers(0, 63, 300))
    codes = sorted({*base.tolist(), *near.tolist()})
    frame = spark.createDataFrame([(c,) for c in codes], "code long")
    monkeypatch.setattr(simhash, "BLOCKS", (20, 64, 1 << 20))
    prints = frame.selectExpr("code AS doc_id", "code AS fingerprint")
    got = {r.fingerprint: r.best for r in simhash.groups(prints, F.col("doc_id"), 4).collect()}
    roots = plain_groups([c & (2 ** 64 - 1) for c in codes], 4)
    assert got == {c: codes[r] for c, r in zip(codes, roots)}
    assert 250 < len(set(got.values())) < len(codes)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    given = texts(sf_dir)
    prints = [plain_print(t) for _, t in given]
    want = {d: (f"{p:016x}", given[r][0])
            for (d, _), p, r in zip(given, prints, plain_groups(prints))}
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in QUERIES["op3_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == want
