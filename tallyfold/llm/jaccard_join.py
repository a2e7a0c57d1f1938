"""Word-shingle Jaccard join by token-combination prefixes.

A token is the 64-bit hash of a shingle; a document's set is its distinct tokens, and equal sets are one
row from the start. Tokens have one order: by their estimated number of sets, the rarest first. With t
the least overlap that a linked partner can have, a set of n tokens differs from it in at most n - t of
them, so a prefix is extended until it covers n - t + 1: a rare token covers one place, and of the
frequent tokens of a class all but one do. Rare tokens of the prefix are indexed one by one, frequent
ones by their pairs within a class. Linked sets then share an entry: else the set whose prefix ends
first had over n - t tokens that the other lacks.

A frequent token's class depends on the band of set sizes, so that a class has a handful of tokens in
a prefix of any length; sets near the end of a band are indexed in the next one too.

An entry is kept only where another set of its key has a size and a place in the order that allow a link,
so that what two sets share by chance costs neither text nor bitmap.

Candidates are compared by bitmaps, whose differing bits bound from below in how many tokens sets differ,
and what passes is verified exactly. In the first rounds every set is held against one other: of the
first sets of its entries, in an order that differs by round, the nearest by bitmap, which connects
groups of near copies by few links. Then the pairs of different components are compared in the
entries that have several. No group of linked sets is written out as pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import shuffles_deleted, staged, text_or_empty
from tallyfold.llm.components import connected

WIDTH = 1 << 22  # counters of the frequency sketch: 16 MB, whatever the corpus
CHUNK = 1 << 14  # counters in a row of its partial sums
KNOWN_SETS = 1 << 18  # digests of a task by which it leaves out sets that it has seen
PIECE, PIECE_WORDS = 1 << 20, 1 << 17  # bytes taken apart together; words of a longer text
BAND = 4  # a band of set sizes ends at this many times its start
ROUNDS, BITS = 3, 256  # rounds of one candidate for each set; bits of a bitmap
_BIT_COLUMNS = [f"b{i}" for i in range(BITS // 64)]
SIEVE = 1 << 25  # bits of the bitmap that says which digests are wanted: 4 MB, whatever the corpus
CELL = 1_024  # sets of an entry that are compared with as many others in a task
#: An entry with more sets is a large one; of a set with more large entries they aren't listed.
HOT, MOST_LARGE = 64, 256
ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]).cumprod(dtype=np.uint64)


class Shingles:
    """Token hashes of texts, from prefix sums of a polynomial over their bytes modulo 2 ** 64.

    Every byte stands for a random number, a capital for the same one as its small letter; words are
    taken as joined by one space. The hash of a shingle is the difference of two prefix sums, moved
    back to the same power.
    """

    def __init__(self, shingle: int):
        self.shingle = shingle
        self.values = np.random.default_rng(7).integers(0, 2 ** 64, 256, np.uint64)
        self.values[ord("A"):ord("Z") + 1] = self.values[ord("a"):ord("z") + 1]
        self.space = np.isin(np.arange(256), [32, *range(9, 14)])
        self.values[self.space] = self.values[32]
        self.up = self.down = np.zeros(0, np.uint64)

    def _hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first byte of each word, its start, its end, prefix sums); starts and ends lie in the
        bytes with one space after each word."""
        space = self.space[data]
        after = np.concatenate([[True], space[:-1]])
        starts = np.flatnonzero(~space & after)
        kept = ~(space & after)
        one = np.append(data[kept], np.uint8(32))
        ends = np.flatnonzero(self.space[one])[:len(starts)]
        if len(self.up) < len(one):
            self.up = _powers(int(ODD), len(one))
            self.down = _powers(pow(int(ODD), -1, 2 ** 64), len(one))
        sums = np.zeros(len(one) + 1, np.uint64)
        np.cumsum(self.values[one] * self.up[:len(one)], out=sums[1:])
        return starts, np.concatenate([[0], ends[:-1] + 1])[:len(starts)], ends, sums

    def _between(self, first, last, start, end, sums) -> np.ndarray:
        """The hash of the words ``first`` to ``last``; how many they are counts as well."""
        at = start[first]
        return _mixed((sums[end[last]] - sums[at]) * self.down[at] + (last - first).astype(np.uint64))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct tokens of each text; a text of fewer words is one, one without none."""
        n = self.shingle
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        at = np.cumsum([len(t) + 1 for t in texts])
        starts, start, end, sums = self._hashes(data)
        edges = np.concatenate([[0], np.searchsorted(starts, at)])
        words = np.arange(len(starts))
        whole = self._between(words[:-n + 1 or None], words[n - 1:], start, end, sums)
        out = []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if high - low >= n:
                found = np.sort(whole[low:high - n + 1])
                new = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=new[1:])
                out.append(found[new])
            else:
                some = words[low:high]
                out.append(self._between(some[:1], some[-1:], start, end, sums))
        return out

    def pieces(self, text: bytes) -> list[bytes]:
        """A long text in pieces that overlap by all words but one of a shingle."""
        words, n = text.split(), self.shingle
        return [b" ".join(words[i:i + PIECE_WORDS + n - 1])
                for i in range(0, max(1, len(words) - n + 1), PIECE_WORDS)]


def _sets(texts: pa.Array, shingles: Shingles) -> Iterator[list[np.ndarray]]:
    """The sets of the texts in order, some at a time."""
    some: list[bytes] = []
    size = 0
    for value in texts.cast(pa.binary()):
        text = value.as_py()
        if some and size + len(text) > PIECE:
            yield shingles.sets(some)
            some, size = [], 0
        if len(text) > PIECE:
            yield [np.unique(np.concatenate(shingles.sets(shingles.pieces(text))))]
        else:
            some.append(text)
            size += len(text)
    if some:
        yield shingles.sets(some)


class NewSets:
    """Digests of sets, and which of them a task hasn't seen lately."""

    def __init__(self):
        self.seen: set[bytes] = set()

    def new(self, some: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
        """(digests as rows (high, low), positions of sets that are not empty and not seen)."""
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in some]
        fresh = []
        for i, digest in enumerate(digests):
            if len(some[i]) and digest not in self.seen:
                if len(self.seen) >= KNOWN_SETS:
                    self.seen.clear()
                self.seen.add(digest)
                fresh.append(i)
        return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2), fresh


def read_sets(docs: DataFrame, shingle: int, width: int = WIDTH) -> DataFrame:
    """(id, n, high, low, chunk, counts) of docs (id, text): the size and a 128-bit digest of each
    set; and rows with a chunk, a task's partial sums of the frequency sketch of ``width`` counters.

    A task counts each set once, but for those that it has forgotten. Partial sums are packed in the
    fewest bytes a counter.
    """
    kind = docs.schema["id"].dataType
    chunk = min(CHUNK, width)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, known, totals = Shingles(shingle), NewSets(), np.zeros(width, np.int32)
        ids = pa.array([], pa.null())
        for batch in batches:
            sizes, digests = [], [np.zeros((0, 2), np.int64)]
            for some in _sets(batch["text"], shingles):
                sizes += [len(s) for s in some]
                rows, fresh = known.new(some)
                digests.append(rows)
                found = [some[i] for i in fresh]
                places = np.concatenate([np.zeros(0, np.uint64), *found]) % np.uint64(width)
                np.add.at(totals, places.astype(np.int64), 1)
            both, ids = np.concatenate(digests), batch["id"]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                 pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.binary())], names)
        places = np.flatnonzero(totals.reshape(-1, chunk).any(axis=1))
        none = pa.nulls(len(places), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(places), ids.type), none, none, none, pa.array(places, pa.int64()),
             pa.array([_packed(totals[p * chunk:(p + 1) * chunk]) for p in places.tolist()],
                      pa.binary())], names)

    names = ["id", "n", "high", "low", "chunk", "counts"]
    return docs.mapInArrow(read, f"id {kind.simpleString()}, n long, high long, low long, "
                                 "chunk long, counts binary")


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype(np.min_scalar_type(int(counts.max()))).tobytes(), 1)


def _unpacked(packed: bytes, chunk: int) -> np.ndarray:
    data = zlib.decompress(packed)
    return np.frombuffer(data, f"u{len(data) // chunk}").astype(np.int64)


def frequency_sketch(docs: DataFrame, shingle: int, width: int = WIDTH,
                     read: DataFrame | None = None) -> np.ndarray:
    """How often the sets have a token of each residue modulo ``width``; all texts are counted, but
    for repeats that a task remembers. ``read`` is what ``read_sets`` gave for them, if it is stored.

    Partial sums are added by chunk in Spark; only the ``width`` totals come to the driver.
    """
    chunk = min(CHUNK, width)
    if read is None:
        read = read_sets(docs.select(F.lit(None).cast("long").alias("id"), "text"), shingle, width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, counts in zip(batch["chunk"].to_pylist(), batch["counts"]):
                part = _unpacked(counts.as_py(), chunk)
                sums[place] = sums[place] + part if place in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()),
             pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["chunk", "counts"])

    parts = min(32, -(-width // chunk))
    summed = read.where("chunk IS NOT NULL").select("chunk", "counts").repartition(
        parts, "chunk").mapInArrow(add, "chunk long, counts binary")
    totals = np.zeros(width, np.int64)
    for row in summed.collect():  # at most ``width`` counters in all
        totals[row["chunk"] * chunk:(row["chunk"] + 1) * chunk] = np.frombuffer(row["counts"],
                                                                                 np.int64)
    return np.minimum(totals, np.iinfo(np.int32).max).astype(np.int32)


def frequent_from(sketch: np.ndarray) -> int:
    """Counts from here on are beyond what the many rare tokens of a residue add up to."""
    mean = float(sketch.mean())
    return int(mean + 6 * mean ** 0.5 + 16)


def _band(n: int) -> int:
    """The number of the band of sizes: [1, 4), [4, 16), ..."""
    return (n.bit_length() - 1) // 2


def _classes(band: int) -> int:
    return max(1, BAND ** band // 8)


class Prefixes:
    """Index entries of a set under the order that a frequency sketch gives.

    The threshold is percent / 100, above a half, so linked different sets have two tokens at least.
    """

    def __init__(self, sketch: np.ndarray, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must lie above 50 and not beyond 100")
        self.sketch, self.percent = sketch, percent
        self.frequent = frequent_from(sketch)

    def entries(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, places): a single's place in the order, 0 for pairs, which any place may have."""
        n = len(found)
        if n < 2:
            return found[:0], np.zeros(0, np.int64)
        need = n + (-self.percent * n // 100) + 1
        counts = self.sketch[(found % np.uint64(len(self.sketch))).astype(np.int64)]
        order = np.argsort(counts, kind="stable")  # ties by token: they are sorted already
        rare = int((counts < self.frequent).sum())
        singles = order[:min(rare, need)]
        keys, places = [_mixed(found[singles])], [np.arange(len(singles))]
        if rare < need:
            common = found[order[rare:]]
            for band in range(_band(n), _band(n * 100 // self.percent) + 1):
                pairs = self._pairs(common, need - rare, band)
                keys.append(pairs)
                places.append(np.zeros(len(pairs), np.int64))
        return np.concatenate(keys), np.concatenate(places)

    def _pairs(self, common: np.ndarray, need: int, band: int) -> np.ndarray:
        """Keys of the pairs within classes, of the shortest prefix that covers ``need`` places."""
        classes = (common >> np.uint64(40)) % np.uint64(_classes(band))
        first = np.zeros(len(common), bool)
        first[np.unique(classes, return_index=True)[1]] = True
        covered = np.cumsum(~first)
        end = int(np.searchsorted(covered, need)) + 1  # beyond the end: all of them
        by = np.lexsort((common[:end], classes[:end]))
        token, of = common[:end][by], classes[:end][by]
        keys = [token[:0]]
        for lag in range(1, len(token)):
            same = of[lag:] == of[:-lag]
            if not same.any():
                break
            keys.append(_mixed(token[:-lag][same] * ODD + token[lag:][same] + np.uint64(band + 1)))
        return np.concatenate(keys)


def postings(docs: DataFrame, shingle: int, prefixes: Prefixes) -> DataFrame:
    """(key, high, low, n, place) of docs (text): the index entries of every set. A set's entries
    may be repeated, as its texts may be."""
    shared = docs.sparkSession.sparkContext.broadcast(prefixes)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, known = Shingles(shingle), NewSets()
        for batch in batches:
            for some in _sets(batch["text"], shingles):
                digests, fresh = known.new(some)
                if not fresh:
                    continue
                found = [shared.value.entries(some[i]) for i in fresh]
                sizes = [len(keys) for keys, _ in found]
                high, low = np.repeat(digests[fresh], sizes, axis=0).T
                n = np.repeat(np.array([len(some[i]) for i in fresh], np.int32), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in (
                    np.concatenate([keys for keys, _ in found]).view(np.int64),
                    np.ascontiguousarray(high), np.ascontiguousarray(low), n,
                    np.concatenate([places for _, places in found]).astype(np.int32))],
                    ["key", "high", "low", "n", "place"])

    return docs.select("text").mapInArrow(
        index, "key long, high long, low long, n int, place int")


def with_partners(entries: DataFrame, percent: int) -> DataFrame:
    """``entries`` (key, high, low, n, place), distinct, without most of those whose key no other set
    has at a size and place that allow a link; where two sets have a key, exactly those are left out.

    A set's ``cap`` is the largest size of a partner that its place allows: two sets of a key may be
    linked where neither is larger than the other's cap.
    """
    by_size = Window.partitionBy("key").orderBy("n", "place", "high", "low")
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    return entries.withColumn("cap", F.expr(
        f"{100 + percent}L * (n - place) div {percent}L - n")).withColumns({
            "smallest": F.min("n").over(before), "reach": F.max("cap").over(before),
            "next": F.lead("n").over(by_size), "next_cap": F.lead("cap").over(by_size),
            "third": F.lead("n", 2).over(by_size)}).where(
        "(reach >= n AND smallest <= cap) OR (next <= cap AND (next_cap >= n OR third IS NOT NULL))"
    ).select(*entries.columns)


def sieve(digests: DataFrame, bits: int = SIEVE) -> np.ndarray:
    """A bitmap of ``bits`` bits, whatever the corpus, that has those of the residues of digests (low)."""
    place = F.expr(f"pmod(low, {bits}L) + 1")  # Spark's bitmaps count from 1
    out = np.zeros((-(-bits // 32768), 4096), np.uint8)
    for row in digests.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("set")).collect():
        out[row["bucket"] - 1] = np.frombuffer(row["set"], np.uint8)
    return out.reshape(-1)


def _passes(bitmap: np.ndarray, low: np.ndarray, bits: int = SIEVE) -> np.ndarray:
    place = low % bits
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def texts_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(row, text): a text of each of the sets ``wanted`` (high, low, row), from docs (text). A sieve
    keeps most other texts from being sent."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve(wanted))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, known = Shingles(shingle), NewSets()
        for batch in batches:
            at = 0
            for some in _sets(batch["text"], shingles):
                digests, fresh = known.new(some)
                fresh = np.array(fresh, np.int64)
                fresh = fresh[_passes(shared.value, digests[fresh, 1])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(digests[fresh, 0]), pa.array(digests[fresh, 1]),
                    batch["text"].take(pa.array(fresh + at))],
                    ["high", "low", "text"])
                at += len(some)

    texts = docs.select("text").mapInArrow(digest, "high long, low long, text string")
    return texts.join(wanted, ["high", "low"]).dropDuplicates(["high", "low"]).select("row", "text")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold. Texts are sent, being smaller than sets, and
    only those of the pairs."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        last, left = None, None
        for batch in batches:
            kept, at = [], 0
            u, texts_u = batch["u"].to_pylist(), batch["a"]
            for some in _sets(batch["b"], shingles):
                for right in some:
                    if u[at] != last:  # rows of one u follow each other
                        last, left = u[at], next(_sets(texts_u.slice(at, 1), shingles))[0]
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    kept.append((100 + percent) * shared >= percent * (len(left) + len(right)))
                    at += 1
            yield pa.RecordBatch.from_arrays([batch["u"], batch["v"]], ["u", "v"]).filter(
                pa.array(kept, pa.bool_()))

    left, right = (texts.toDF(of, text).join(pairs.select(of), of, "left_semi")
                   for of, text in (("u", "a"), ("v", "b")))
    both = pairs.join(right, "v").join(left, "u")
    return both.select("u", "v", "a", "b").mapInArrow(check, "u long, v long")


def _may_link(left: str, right: str, percent: int) -> str:
    """SQL: the sizes allow the threshold."""
    return f"100L * least({left}.n, {right}.n) >= {percent}L * greatest({left}.n, {right}.n)"


def bitmaps(texts: DataFrame, shingle: int) -> DataFrame:
    """(row, b0, b1, ...): BITS bits of each set, a bit being the parity of its tokens with that residue.

    Sets differ in at least as many tokens as their bitmaps do in bits.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            found = [np.packbits(np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS)
                                 .astype(np.uint8) & 1).view(np.int64)
                     for some in _sets(batch["text"], shingles) for s in some]
            columns = np.array(found).reshape(-1, BITS // 64).T
            yield pa.RecordBatch.from_arrays(
                [batch["row"], *[pa.array(np.ascontiguousarray(c)) for c in columns]],
                ["row", *_BIT_COLUMNS])

    return texts.mapInArrow(read, "row long, " + ", ".join(f"{c} long" for c in _BIT_COLUMNS))


def _bits_apart(left: str, right: str) -> str:
    return " + ".join(f"bit_count({left}.{c} ^ {right}.{c})" for c in _BIT_COLUMNS)


def _with_roots(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:  # nothing is linked yet
        return shared.withColumn("root", F.col("row"))
    return shared.join(roots, shared["row"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "row")).drop("node")


def _places_allow(left: str, right: str, percent: int) -> str:
    """SQL: the places of the first token that both have allow the threshold."""
    return (f"{100 + percent}L * least({left}.n - {left}.place, {right}.n - {right}.place) >= "
            f"{percent}L * ({left}.n + {right}.n)")


def _allowed(left: str, right: str, percent: int) -> str:
    """SQL: two sets of one entry lie in different components, and sizes and bitmaps allow a link:
    linked sets differ by all tokens less twice the least that they share."""
    return (f"{left}.root <> {right}.root AND {_may_link(left, right, percent)} AND "
            f"{_bits_apart(left, right)} <= {left}.n + {right}.n "
            f"- 2 * ceil({percent}D * ({left}.n + {right}.n) / {100 + percent}D - 1e-9)")


def _one_each(shared: DataFrame, roots: DataFrame | None, percent: int, number: int) -> DataFrame:
    """Candidates (u, v): for every set, of the first sets of its entries, in an order that differs by
    round, the one with the nearest bitmap of those that may be linked and aren't connected yet."""
    turn = F.col("row") if number == 0 else F.xxhash64("row", F.lit(number))
    known = _with_roots(shared, roots).withColumn("turn", turn)
    first = known.groupBy("key").agg(
        F.min(F.struct("turn", "row", "n", "place", "root", *_BIT_COLUMNS)).alias("first"),
        F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    met = known.alias("k").join(first.select("key", "first"), "key").where(
        f"{_allowed('first', 'k', percent)} AND {_places_allow('first', 'k', percent)}")
    return met.groupBy(F.col("k.row").alias("v")).agg(F.min(F.struct(
        F.expr(_bits_apart("first", "k")).alias("apart"), "first.row")).alias("best")).select(
        F.col("best.row").alias("u"), "v")


def _across(shared: DataFrame, roots: DataFrame | None, percent: int) -> DataFrame:
    """Candidates (u, v): the pairs of an entry that lie in different components and may be linked.

    The sets of an entry are dealt into parts, and each pair of parts is a cell of bounded size.
    """
    known = _with_roots(shared, roots)
    mixed = (known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.count("*").alias("members"))
             .where("low <> high").selectExpr(
                 "key", f"CAST(ceil(members / {CELL}) AS INT) AS parts", f"members > {HOT} AS hot"))
    open_ = staged(known.join(mixed, "key"), "open")
    # two sets meet in many large entries: they are given by the least one that both are in
    large = open_.where("hot").groupBy("row").agg(F.collect_list("key").alias("large")).selectExpr(
        "row", f"IF(size(large) <= {MOST_LARGE}, large, NULL) AS large")
    every = F.explode(F.expr("sequence(0L, CAST(parts AS BIGINT) - 1)"))
    dealt = staged(open_.join(large, "row", "left").withColumn(
        "large", F.expr("IF(hot, large, NULL)")).withColumn(
        "part", F.expr("pmod(xxhash64(row), parts)")).withColumn("other", every), "dealt")
    met = dealt.alias("l").join(dealt.alias("r"), F.expr(
        "l.key = r.key AND l.part = r.other AND l.other = r.part AND l.row < r.row "
        f"AND {_allowed('l', 'r', percent)} AND IF(l.large IS NULL OR r.large IS NULL, "
        f"l.hot OR ({_places_allow('l', 'r', percent)}), "
        "l.key = array_min(array_intersect(l.large, r.large)))"))
    return met.select(F.col("l.row").alias("u"), F.col("r.row").alias("v")).distinct()


def linked_sets(docs: DataFrame, distinct: DataFrame, prefixes: Prefixes,
                shingle: int) -> DataFrame:
    """(node, root) of the rows of ``distinct`` (high, low, row), the sets of docs (text), that links
    connect; roots are left out."""
    percent = prefixes.percent
    # A set has one row in an entry, and many entries, so no entry has a large share of the rows.
    entry, both = Window.partitionBy("key"), F.struct("high", "low")
    several = staged(with_partners(postings(docs, shingle, prefixes).withColumn(
        "least", F.min(both).over(entry)).withColumn("most", F.max(both).over(entry)).where(
        "least <> most").drop("least", "most").distinct(), percent), "several")
    wanted = staged(several.select("high", "low").distinct().join(distinct, ["high", "low"]),
                    "wanted")
    texts = staged(texts_of(docs, wanted, shingle), "texts")
    known = staged(wanted.join(bitmaps(texts, shingle), "row"), "bitmaps")
    shared = staged(several.join(known, ["high", "low"]).drop("high", "low"), "shared")
    roots = None

    def tested(pairs: DataFrame) -> DataFrame:
        found = verified(staged(pairs, "candidates"), texts, shingle, percent)
        return connected(found if roots is None else roots.toDF("u", "v").unionByName(found))

    for number in range(ROUNDS):
        roots = tested(_one_each(shared, roots, percent, number))
    return tested(_across(shared, roots, percent))


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                       shingle: int = 4, percent: int = 85) -> DataFrame:
    """One row for each row of ``docs``: id_column, n_shingles, component_id.

    Two documents link where their sets' similarity is percent / 100 (above a half) or more;
    component_id is the least id that links reach, itself included. Null ids count only where a
    component has no other. Texts without words (null, empty, white space) have an empty set and
    are linked with nothing; repeated rows are members like others. An empty table gives an empty
    one; other columns are not looked at. Shingles are compared by 64-bit hashes, sets by 128-bit
    digests of these. ``docs`` is read three times and must give the same texts each time.
    """
    read = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    with shuffles_deleted(docs.sparkSession):
        sets = staged(read_sets(read, shingle), "sets")
        prefixes = Prefixes(frequency_sketch(read, shingle, read=sets), percent)
        printed = sets.where("chunk IS NULL").drop("chunk", "counts")
        distinct = staged(printed.where("n > 0").groupBy("high", "low").agg(
            F.min("id").alias("least")).withColumn("row", F.monotonically_increasing_id()), "distinct")
        roots = linked_sets(read, distinct.drop("least"), prefixes, shingle)
        grouped = staged(distinct.join(roots, F.col("row") == F.col("node"), "left").select(
            "high", "low", F.coalesce("root", "row").alias("root"), "least"), "grouped")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    found = grouped.join(least, "root").select("high", "low", "component_id")
    full = printed.where("n > 0").join(found, ["high", "low"]).select(
        "id", F.col("n").alias("n_shingles"), "component_id")
    none = printed.where("n = 0").select("id", F.col("n").alias("n_shingles"),
                                         F.col("id").alias("component_id"))
    return full.unionByName(none).withColumnRenamed("id", id_column)
