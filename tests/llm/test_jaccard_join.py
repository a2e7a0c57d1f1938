import random
import time
from pathlib import Path

import numpy as np
import pytest

from tallyfold.llm import jaccard_join
from tallyfold.llm.queries import QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents, texts

SPACES = "\t\n\x0b\x0c\r"


def plain_set(text, k=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.translate({ord(c): " " for c in SPACES}).split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_components(sets, percent=85):
    """Least index that links reach, by depth-first search over all pairs."""
    root = [None] * len(sets)
    for i in range(len(sets)):
        if root[i] is None:
            todo, root[i] = [i], i
            while todo:
                a = sets[todo.pop()]
                for k, b in enumerate(sets):
                    if root[k] is None and a and b and 100 * len(a & b) >= percent * len(a | b):
                        root[k] = i
                        todo.append(k)
    return root


def check(spark, given, percent=85, shingle=4):
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(
        frame, percent=percent, shingle=shingle).collect()}
    sets = [plain_set(t, shingle) for t in given]
    assert got == {i: (len(s), r) for i, (s, r) in enumerate(zip(
        sets, plain_components(sets, percent)))}
    return got


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def corpus(rng, groups=12, copies=9):
    """Near copies at many distances, a passage in most texts, exact copies and short texts."""
    passage = [f"p{i}" for i in range(60)]
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 9, 30, 120, 400]))]
        for c in range(copies):
            words = edited(rng, base, rng.randrange(1 + len(base) // 12))
            if c % 3:
                at = rng.randrange(len(words))
                words[at:at] = passage
            out.append(" ".join(words))
    return out + out[::7] + [" ".join(passage)] * 3 + ["a b c d e f g h i j", "A b c d e f g h i j",
                                                       "a b c", "a b c", "a  b\tc", "x", "", " "]


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_components_equal_all_pairs(spark, percent):
    got = check(spark, corpus(random.Random(percent)), percent)
    assert len({c for _, c in got.values()}) < len(got)


def test_frequent_tokens_by_pairs_and_small_cells(spark, monkeypatch):
    """Every token that occurs twice counts as frequent; entries of four sets are cut into cells."""
    monkeypatch.setattr(jaccard_join, "frequent_from", lambda sketch: 2)
    monkeypatch.setattr(jaccard_join, "CELL", 3)
    check(spark, corpus(random.Random(5), groups=8))
    check(spark, corpus(random.Random(6), groups=5), percent=70, shingle=1)


@pytest.mark.parametrize("hot,most_large,rounds", [(2, 256, 1), (3, 4, 0)])
def test_pairs_of_large_entries(spark, monkeypatch, hot, most_large, rounds):
    """Pairs that meet in many large entries are given once, whether their entries are listed or not."""
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "MOST_LARGE", most_large)
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    given = [" ".join(edited(rng, base, rng.randrange(6))) for _ in range(40)]
    check(spark, given + corpus(rng, groups=3))


@pytest.mark.parametrize("percent", [51, 70, 85, 95])
@pytest.mark.parametrize("frequent", [0, 3, 10 ** 9])
def test_linked_sets_share_an_entry(monkeypatch, percent, frequent):
    monkeypatch.setattr(jaccard_join, "frequent_from", lambda sketch: frequent)
    rng = np.random.default_rng(percent)
    sketch = rng.integers(0, 6, 1 << 10).astype(np.int32)
    prefixes = jaccard_join.Prefixes(sketch, percent)
    linked = 0
    for _ in range(1500):
        size = int(rng.choice([2, 3, 5, 8, 15, 17, 40, 63, 70, 260, 1100]))
        a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
        gone = int(rng.integers(0, 1 + len(a) * (100 - percent) // 100))
        new = int(rng.integers(0, 1 + len(a) * (100 - percent) // 100))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:],
                                      rng.integers(0, 2 ** 63, new).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) > 1 and 100 * both >= percent * (len(a) + len(b) - both):
            (x, i), (y, j) = prefixes.entries(a), prefixes.entries(b)
            shared, at, to = np.intersect1d(x, y, return_indices=True)
            least = np.minimum(len(a) - i[at], len(b) - j[to]).max(initial=0)
            assert len(shared) and (100 + percent) * least >= percent * (len(a) + len(b))
            assert len(x) <= 8 * len(a)
            linked += 1
    assert linked > 300


def test_hot_group_writes_no_pairs(spark):
    """Of a group of near copies only links to the entries' first sets are tested."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    given = [" ".join(edited(rng, base, 2)) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(given)), "id long, text string")
    prefixes = jaccard_join.Prefixes(jaccard_join.frequency_sketch(frame, 4), 85)
    entries = jaccard_join.postings(frame, 4, prefixes)
    assert entries.count() < 150 * 100
    check(spark, given)


def test_sketch_counts_all_sets(spark):
    given = [f"a b c d e{i}" for i in range(80)] + ["x"] * 5
    frame = spark.createDataFrame(list(enumerate(given)), "id long, text string").repartition(5)
    sketch = jaccard_join.frequency_sketch(frame, 4, width=64)
    assert 80 * 2 < sketch.sum() <= 80 * 2 + 5 and sketch.max() >= 80


@pytest.mark.parametrize("shingle", [1, 2, 4])
def test_token_sets_are_those_of_the_words(monkeypatch, shingle):
    monkeypatch.setattr(jaccard_join, "PIECE", 500)
    monkeypatch.setattr(jaccard_join, "PIECE_WORDS", 7)
    rng = random.Random(shingle)
    texts = [t or "" for t in AWKWARD] + [
        "".join(rng.choice(["a", "B", "b", "é", " ", "\n", "\x0b", "\xa0", "cc"]) for _ in range(
            rng.randrange(80))) for _ in range(400)] + ["a b " * 400, "A b a B" * 300, "x" * 900]
    import pyarrow as pa

    found = [s for some in jaccard_join._sets(pa.array(texts), jaccard_join.Shingles(shingle))
             for s in some]
    plain = [plain_set(t, shingle) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in plain]
    token = {}
    for hashes, grams in zip(found, plain):
        if len(grams) == 1:
            assert token.setdefault(*grams, int(hashes[0])) == hashes[0]
    assert len(set(token.values())) == len(token)
    for i in range(0, len(texts) - 1):
        both = len(np.intersect1d(found[i], found[i + 1]))
        assert both == len(plain[i] & plain[i + 1])


def test_bitmaps_bound_the_difference(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    given = [" ".join(edited(rng, base, rng.randrange(12))) for _ in range(40)] + ["", "a b"]
    frame = spark.createDataFrame(list(enumerate(given)), "row long, text string")
    rows = {r.row: [r[c] for c in jaccard_join._BIT_COLUMNS]
            for r in jaccard_join.bitmaps(frame, 4).collect()}
    sets = [plain_set(t) for t in given]
    tight = 0
    for i in range(len(given)):
        for j in range(i):
            apart = sum(((a ^ b) & (2 ** 64 - 1)).bit_count() for a, b in zip(rows[i], rows[j]))
            assert apart <= len(sets[i] ^ sets[j])
            tight += apart > 0.8 * len(sets[i] ^ sets[j])
    assert tight > 400


def test_stars_of_copies_that_only_the_original_links(spark):
    """Copies are linked to the original, not to each other, whatever its place among them."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    for at in (0, 20, 39):
        given = [" ".join(edited(rng, base, 7)) for _ in range(39)]
        given.insert(at, " ".join(base))
        got = check(spark, given)
        assert len({c for _, c in got.values()}) == 1


def test_awkward_rows(spark):
    frame = documents(spark, AWKWARD, first=50)
    rows = frame.select("doc_id", "text").collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id))
    sets = [plain_set(rows[i].text) for i in order]
    want = sorted(str((rows[i].doc_id, len(s), rows[order[r]].doc_id))
                  for i, s, r in zip(order, sets, plain_components(sets)))
    got = jaccard_join.jaccard_components(frame)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert jaccard_join.jaccard_components(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.Prefixes(np.zeros(4, np.int32), 50)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    given = texts(sf_dir)
    sets = [plain_set(t) for _, t in given]
    want = {d: (len(s), given[r][0]) for (d, _), s, r in zip(given, sets, plain_components(sets))}
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in QUERIES["op11_ngram_jaccard_join"](spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_entries_without_partners_are_left_out(spark, percent):
    """A row with an allowed partner stays; of two sets of a key those that can't be linked go."""
    rng = random.Random(percent)
    rows = []
    for key in range(400):
        for one in range(2 if key % 2 else rng.randrange(1, 9)):
            n = rng.randrange(10, 60)
            rows.append((key, one, 7, n, 0 if key % 5 == 0 else rng.randrange(n)))
    kind = "key long, high long, low long, n int, place int"
    kept = jaccard_join.with_partners(spark.createDataFrame(rows, kind), percent)
    assert kept.columns == ["key", "high", "low", "n", "place"]
    kept = {tuple(r) for r in kept.collect()}

    def allowed(a, b):
        return (100 + percent) * min(a[3] - a[4], b[3] - b[4]) >= percent * (a[3] + b[3])

    want = {a for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and allowed(a, b)}
    pairs = {r for r in rows if r[0] % 2}
    assert want and want <= kept < set(rows) and kept & pairs == want & pairs


def test_only_wanted_texts_are_sent(spark):
    """The sieve passes all wanted digests, and of others few; a text of each wanted set is found."""
    given = [f"a{i} b c d e" for i in range(200)] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "id long, text string")
    sets = jaccard_join.read_sets(docs, 4).where("chunk IS NULL")
    assert sets.count() == 400
    wanted = sets.where("id < 20").select("high", "low", "id").toDF("high", "low", "row").cache()
    bitmap = jaccard_join.sieve(wanted)
    assert bitmap.nbytes * 8 == jaccard_join.SIEVE and 0 < np.unpackbits(bitmap).sum() <= 20
    low = np.array([r.low for r in sets.collect()])
    passed = jaccard_join._passes(bitmap, low)
    assert passed[:20].all() and passed[200:220].all() and passed.sum() < 50
    got = {r.row: r.text for r in jaccard_join.texts_of(docs, wanted, 4).collect()}
    assert got == dict(enumerate(given[:20]))


def test_partial_sums_are_packed_and_summed(spark):
    """Counts beyond a byte, and stored sums, give the sketch that the texts give."""
    for counts in ([0, 3, 1, 0], [255, 256, 0, 1], [70_000, 1, 2, 3]):
        packed = jaccard_join._packed(np.array(counts, np.int32))
        assert jaccard_join._unpacked(packed, 4).tolist() == counts
    given = [f"{'same words stand here ' * 2}e{i}" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(given)), "id long, text string").repartition(3)
    plain = np.zeros(64, np.int64)
    for text in given:
        for found in jaccard_join.Shingles(4).sets([text.encode()]):
            np.add.at(plain, (found % np.uint64(64)).astype(np.int64), 1)
    stored = jaccard_join.read_sets(docs, 4, 64).cache()
    for read in (None, stored):
        assert (jaccard_join.frequency_sketch(docs, 4, 64, read) == plain).all()
    assert plain.max() >= 600


def test_shuffle_files_are_deleted_with_their_query(spark):
    """The operator leaves no shuffle files of its many staged tables, and the setting as it was."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager(
        ).diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in Path(d).rglob("shuffle_*")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name, None)
    given = corpus(random.Random(8), groups=3, copies=4)
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    jaccard_join.jaccard_components(frame)
    for _ in range(50):  # deleted in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(name, None) == setting
