"""Benchmark decontamination with suffix arrays over shards of the training documents.

Each task turns its documents into shards of bounded size, builds a word-level suffix array of every
shard, and binary-searches all suffixes of the benchmark items in it. That gives the range of the
suffixes that start with a window and, as the items' suffixes are sorted too, each training suffix's
neighbours among them, one of which has the longest verbatim match there. A document lies in one
shard, so nothing is shuffled. Shards have no boundary effects: a separator that no item holds
stands behind each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tallyfold.llm.common import fresh, slices, staged, text_or_empty

SHARD_BYTES = 4 << 20
BLOCK_WORDS = 200_000
LONG_MATCH, STRIDE = 64, 256
OCCURRENCES = ("n_words:long, hits:array<struct<start:int,end:int>>, items:array<string>, "
               "longest:int, longest_item:string, longest_item_start:int, longest_start:int")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)  # of lower-cased UTF-8 bytes: [^\x00-\x2F\x3A-\x60\x7B-\x7F]
_IS_WORD[ord("0"):ord("9") + 1] = _IS_WORD[ord("a"):ord("z") + 1] = _IS_WORD[128:] = True


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def word_keys(texts: list[str], prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit keys of all words in order, or of their first ``prefix`` bytes, number of words of each
    text).

    Words of up to 8 bytes have their bytes as key, mixed; longer ones a hash over their 8-byte
    pieces. Two words share a key by chance only (2**-64 a pair); a false hit would need that inside
    a window whose other words all match.
    """
    encoded = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    data = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", np.uint8)]
    inside = _IS_WORD[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    text_ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    ends = ends if prefix is None else np.minimum(ends, starts + prefix)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    length = ends - starts
    keys = length.astype(np.uint64)
    todo, at = np.arange(len(starts)), starts
    while len(todo):
        left = np.minimum(ends[todo] - at, 8)
        piece = eights[at].view(np.uint64).ravel() if len(at) else np.zeros(0, np.uint64)
        shift = (np.uint64(8) * (np.uint64(8) - left.astype(np.uint64)))
        piece = (piece << shift) >> shift
        keys[todo] = mix((keys[todo] * np.uint64(0x9E3779B97F4A7C15)) ^ piece)
        more = left == 8
        todo, at = todo[more], at[more] + 8
        still = ends[todo] > at
        todo, at = todo[still], at[still]
    return keys, counts


def words_of(text: str) -> list[str]:
    """The words of one text, the plain way."""
    lower = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    return np.where(_IS_WORD[lower], lower, 32).astype(np.uint8).tobytes().decode().split(" ")


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes whose first id is 2 or more, in order of their ids.

    An id below 2 (a separator or a word that no query holds) ends a suffix: behind it nothing can
    match. The first round sorts by as many ids as fit into one 63-bit key; each further one doubles
    the length among ties, until none is left or ``depth`` ids are in order.
    """
    n, bits = len(ids), int(ids.max(initial=1) + 1).bit_length()
    have = 63 // bits
    position = np.arange(n + 1)
    stop = np.where(np.append(ids, 0) < 2, position, n)
    run = (np.minimum.accumulate(stop[::-1])[::-1] - position)[:n]  # ids before the suffix ends
    starts = np.flatnonzero(run)
    padded = np.append(ids, np.zeros(have, ids.dtype))
    key = np.zeros(len(starts), np.int64)
    for k in range(have):
        key = (key << bits) | np.where(run[starts] > k, padded[starts + k], 0)
    by = np.argsort(key)
    order, key = starts[by], key[by]
    first = np.ones(len(order), bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.full(n + 1, -1, np.int64)
    while have < depth:
        tied = ~first
        tied[:-1] |= ~first[1:]
        place = np.flatnonzero(tied & (run[order] >= have))
        if not len(place):
            break
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        members = order[place]
        group, follow = rank[members], rank[np.minimum(members + have, n)]
        sub = np.lexsort((follow, group))
        order[place] = members[sub]
        group, follow = group[sub], follow[sub]
        first[place[1:]] |= (group[1:] == group[:-1]) & (follow[1:] != follow[:-1])
        have *= 2
    return order


@dataclass
class Block:
    """Benchmark items of a bounded number of words, laid end to end."""

    item_ids: list[str]
    keys: np.ndarray       # of the words of all items
    item_of: np.ndarray    # item of each word
    starts: np.ndarray     # first word of each item
    lengths: np.ndarray    # words of each item
    window: int

    @staticmethod
    def of(items: list[tuple[str, str]], window: int) -> Block:
        keys, counts = word_keys([text for _, text in items])
        starts = np.cumsum(counts) - counts
        return Block([i for i, _ in items], keys, np.repeat(np.arange(len(items)), counts), starts,
                     counts, window)

    @cached_property
    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted keys of the vocabulary, ids from 2 of all words, words by the suffix they start)."""
        vocabulary, known = np.unique(self.keys, return_inverse=True)
        query = known.astype(np.int64) + 2
        apart = np.insert(query, self.starts + self.lengths, 0)
        order = suffix_array(apart, int(self.lengths.max(initial=0)))
        return vocabulary, query, (np.cumsum(apart > 0) - 1)[order]

    def search(self, texts: list[str]) -> list[tuple]:
        """An ``OCCURRENCES`` tuple for every text."""
        keys, counts = word_keys(texts)
        vocabulary, query, sorted_words = self.index
        place = np.searchsorted(vocabulary, keys)
        place[place == len(vocabulary)] = 0
        # Ids: separator 0, words that no item holds 1, the items' words from 2.
        ids = np.where(vocabulary[place] == keys, place + 2, 1) if len(vocabulary) else np.ones(
            len(keys), np.int64)
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends, 0)
        text_starts = ends - counts + np.arange(len(counts))
        length = int(self.lengths.max(initial=0))
        order = suffix_array(ids, length)
        if not len(order):
            return [(int(c), [], [], 0, None, None, None) for c in counts]
        remaining = (self.starts + self.lengths)[self.item_of] - np.arange(len(query))
        # what an item suffix has in common with the one next to where it would be
        at = _lower_bound(ids, order, query, remaining)
        lcp = np.zeros(len(query), np.int64)
        for neighbour in (at - 1, at):
            inside = (neighbour >= 0) & (neighbour < len(order))
            start = order[np.clip(neighbour, 0, len(order) - 1)]
            lcp = np.maximum(lcp, np.where(inside, _common(ids, start, query, remaining), 0))
        # longest matches: every training suffix stands between two item suffixes
        beyond = np.searchsorted(at[sorted_words], np.arange(len(order)), side="right")
        longest, word = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for neighbour in (beyond - 1, beyond):
            inside = (neighbour >= 0) & (neighbour < len(sorted_words))
            next_to = np.full(len(ids), -1)
            next_to[order[inside]] = sorted_words[neighbour[inside]]
            common = _along(ids, query, remaining, next_to)
            word = np.where(common > longest, next_to, word)
            longest = np.maximum(longest, common)
        # windows: all suffixes that start with one
        whole = (self.lengths < self.window) & (self.lengths > 0)
        size = np.where(whole, self.lengths, self.window)[self.item_of]
        is_window = np.flatnonzero(remaining >= size)
        is_window = is_window[lcp[is_window] >= size[is_window]]
        size = size[is_window]
        low = _lower_bound(ids, order, query, size, is_window)
        high = _lower_bound(ids, order, query, size, is_window, after=True)
        found = high - low
        start = order[np.repeat(low, found) + np.arange(found.sum()) - np.repeat(
            np.cumsum(found) - found, found)]
        end = start + np.repeat(size, found)
        item = np.repeat(self.item_of[is_window], found)
        text = np.searchsorted(text_starts, start, side="right") - 1
        return self._by_text(texts, counts, text_starts, text, start, end, item, longest, word)

    def _by_text(self, texts, counts, text_starts, text, start, end, item, longest, word):
        n = len(texts)
        hits, items = [[] for _ in range(n)], [[] for _ in range(n)]
        if len(text):
            by = np.lexsort((end, start, text))
            t, s, e = text[by], start[by] - text_starts[text[by]], end[by] - text_starts[text[by]]
            # union of the intervals of a text: one begins where it passes the furthest end so far
            far = np.maximum.accumulate(e + t * (1 << 40)) - t * (1 << 40)
            begins = np.ones(len(t), bool)
            begins[1:] = (t[1:] != t[:-1]) | (s[1:] > far[:-1])
            at = np.flatnonzero(begins)
            closes = np.append(at[1:], len(t)) - 1
            for k, a, b in zip(t[at].tolist(), s[at].tolist(), far[closes].tolist()):
                hits[k].append((a, b))
            pairs = np.unique(text * len(self.item_ids) + item)
            for pair in pairs.tolist():
                items[pair // len(self.item_ids)].append(self.item_ids[pair % len(self.item_ids)])
        # the longest match of each text, the first of several
        matched = np.flatnonzero(longest)
        places = np.searchsorted(text_starts, matched, side="right") - 1
        by = np.lexsort((matched, -longest[matched], places))
        best: dict[int, tuple] = {}
        for k, one in zip(*(x.tolist() for x in np.unique(places[by], return_index=True))):
            at = matched[by[one]]
            q = word[at]
            i = int(self.item_of[q])
            best[k] = (int(longest[at]), self.item_ids[i], int(q - self.starts[i]),
                       int(at - text_starts[k]))
        return [(int(counts[k]), hits[k], items[k], *best.get(k, (0, None, None, None)))
                for k in range(n)]


def _common(ids, start, query, limit, which=None, known=None):
    """Length of the common beginning of suffixes of ``ids`` and of ``query`` (up to ``limit``), of
    which ``known`` words are the same already."""
    n = len(ids)
    which = np.arange(len(start)) if which is None else which
    length = np.zeros(len(start), np.int64) if known is None else known.copy()
    go = np.flatnonzero(limit > length)
    while len(go):
        there = start[go] + length[go]
        same = (there < n) & (ids[np.minimum(there, n - 1)] == query[which[go] + length[go]])
        go = go[same]
        length[go] += 1
        go = go[limit[go] > length[go]]
    return length


def _along(ids, query, remaining, next_to):
    """Length that each suffix of ``ids`` has in common with the query suffix ``next_to`` it (-1: none).

    A suffix has at least what the one a word before it has, less that word. So beyond LONG_MATCH
    words, suffixes in a row are walked one after another (STRIDE of them, all rows at once), each from
    where the one before it ended: long copies cost no square of their length.
    """
    length = np.zeros(len(ids), np.int64)
    start = np.flatnonzero(next_to >= 0)
    which = next_to[start]
    length[start] = _common(ids, start, query, np.minimum(remaining[which], LONG_MATCH), which)
    long = np.flatnonzero(length == LONG_MATCH)
    if len(long):
        number = np.arange(len(long))
        begins = np.append(True, long[1:] != long[:-1] + 1)
        turn = (number - np.maximum.accumulate(np.where(begins, number, 0))) % STRIDE
        by = np.argsort(turn, kind="stable")
        for start in np.split(long[by], np.cumsum(np.bincount(turn))[:-1]):
            which = next_to[start]
            known = np.maximum(length[start - 1] - 1, LONG_MATCH)
            length[start] = _common(ids, start, query, remaining[which], which, known)
    return length


def _lower_bound(ids, order, query, limit, which=None, after=False):
    """First place in ``order`` not below (``after``: beyond) each query suffix cut at ``limit``."""
    which = np.arange(len(query)) if which is None else which
    low, high = np.zeros(len(which), np.int64), np.full(len(which), len(order), np.int64)
    n = len(ids)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        start, below = order[middle], np.full(len(open_), after)
        go, step = np.arange(len(open_)), 0
        cut = limit[open_]
        while len(go):
            there = start[go] + step
            a = np.where(there < n, ids[np.minimum(there, n - 1)], -1)
            b = query[which[open_[go]] + step]
            below[go[a < b]] = True
            below[go[a > b]] = False
            go = go[a == b]
            step += 1
            go = go[cut[go] > step]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def benchmark_blocks(items: DataFrame, window: int, block_words: int) -> Iterator[Block]:
    """The items, as one block after another of about ``block_words`` words (or one longer item).

    The driver holds one block at a time. Ids become strings; a null id is the empty string.
    """
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"),
                        text_or_empty("text").alias("text"))
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row.id, row.text))
        size += len(row.text) // 4 + 1
        if size >= block_words:
            yield Block.of(held, window)
            held, size = [], 0
    if held:
        yield Block.of(held, window)


def occurrences(docs: DataFrame, items: DataFrame, text: str | Column = "text", window: int = 13,
                shard_bytes: int = SHARD_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with an array column ``found`` (underscores if taken): an ``OCCURRENCES`` struct of
    the benchmark's first block, and of each further one in which the document has a match.

    hits: word ranges of the document that windows of items cover, merged, end exclusive. items: ids
    with an occurring window, repeats possible if ids repeat. longest and the next three: the words of
    the document's longest match with an item (0 and nulls: none), an item that holds it, and where it
    starts in the item and, the first of several, in the document. A window is
    ``window`` words in a row, or the whole item if that has fewer (none: no window). Null or empty
    texts have no words. Every row stays, repeated ones too. A benchmark of one block takes one pass
    without a shuffle. Beyond ``block_words`` the rows are staged and searched for one block after
    another: only one block at a time is held by the driver and the executors.
    """
    name, spark = fresh(docs, "found"), docs.sparkSession
    blocks = benchmark_blocks(items, window, block_words)
    first, second = next(blocks, Block.of([], window)), next(blocks, None)
    if second is None:
        search = _searcher(spark.sparkContext.broadcast(first), shard_bytes)
        return docs.withColumn(name, F.array(search(text_or_empty(text))))
    row = fresh(docs, "row_number")
    table = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found: list[DataFrame] = []
    for block in chain([first, second], blocks):
        sent = spark.sparkContext.broadcast(block)
        one = table.select(row, _searcher(sent, shard_bytes)(text_or_empty(text)).alias(name))
        if found:
            one = one.where((F.size(F.col(name)["hits"]) > 0) | (F.col(name)["longest"] > 0))
        found.append(staged(one, "found"))
        sent.destroy()
    every = reduce(DataFrame.unionAll, found).groupBy(row).agg(F.collect_list(name).alias(name))
    return table.join(every, row).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def _searcher(block, shard_bytes: int):
    @arrow_udf(f"struct<{OCCURRENCES}>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([
            ("n_words", pa.int64()),
            ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())), ("longest", pa.int32()),
            ("longest_item", pa.string()), ("longest_item_start", pa.int32()),
            ("longest_start", pa.int32())])
        for batch in batches:
            rows = [row for texts in slices(batch, shard_bytes)
                    for row in block.value.search(texts)]
            columns = list(zip(*rows)) or [()] * len(kind)
            hits = [[{"start": a, "end": b} for a, b in x] for x in columns[1]]
            values = [columns[0], hits, *columns[2:]]
            yield pa.StructArray.from_arrays(
                [pa.array(v, kind.field(i).type) for i, v in enumerate(values)],
                [f.name for f in kind])

    return search


def verdicts(docs: DataFrame, items: DataFrame, text: str | Column = "text", **options) -> DataFrame:
    """``docs`` with a struct column ``verdict`` (underscores if taken): n_words, n_hit, n_items,
    items_sha256, contaminated, longest, longest_item, longest_item_start, longest_start, and the ``hits``
    of every block by start.

    n_hit: words inside any window's occurrence. items_sha256: hex digest of the distinct ids, sorted
    as strings and comma-joined. contaminated: a twentieth of the words or more is hit.
    """
    found = occurrences(docs, items, text, **options)
    name = found.columns[-1]
    at = F.col(name)
    blocks = F.transform(at, lambda b: b["hits"])
    # positions over all blocks: one block's ranges are merged already
    many = F.array_distinct(F.flatten(F.transform(F.flatten(blocks), lambda h: F.sequence(
        h["start"], h["end"] - 1))))
    n_hit = F.when(F.size(at) == 1, F.aggregate(
        F.flatten(blocks), F.lit(0).cast("long"),
        lambda a, h: a + h["end"] - h["start"])).otherwise(F.size(many).cast("long"))
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(at, lambda b: b["items"]))))
    n_words = at[0]["n_words"]
    # of the blocks' longest matches the first in the document
    best = F.array_max(F.transform(at, lambda b: F.struct(
        b["longest"], (-b["longest_start"]).alias("before"), b["longest_item"],
        b["longest_item_start"])))
    verdict = F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
        best["longest"].alias("longest"), best["longest_item"].alias("longest_item"),
        best["longest_item_start"].alias("longest_item_start"),
        (-best["before"]).alias("longest_start"), F.array_sort(F.flatten(blocks)).alias("hits"))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns],
                        verdict.alias(fresh(docs, "verdict")))


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns as they were."""
    judged = verdicts(docs, items, text, **options)
    return judged.where(~F.col(judged.columns[-1])["contaminated"]).drop(judged.columns[-1])
