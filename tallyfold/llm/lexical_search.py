"""Ranked lexical search of many items at once by shared partial accumulators.

A document's score for an item is a sum over the item's terms, so what items have in common is summed
once. Terms that stand in exactly the same items are one leaf, their sum one accumulator. The leaves
of an item are put in one order, the most shared first; pairs of neighbours that several items have
become a new accumulator, again and again, until no pair is shared. The result is a graph of sums:
leaves, sums of two earlier nodes, and for each item the node that is its score.

Documents are read where they lie, twice: once for the numbers of documents and terms, once for the
scores. A task fills the accumulators of a batch of documents level by level and keeps the best k
documents of each item; the tasks' best are merged by rank. Items come in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import best_of, slices, staged, text_or_empty

#: Bytes of item texts in a block, accumulator cells of a batch, bytes of texts taken together.
BLOCK_BYTES, CELLS, SLICE_BYTES = 1 << 20, 4 << 20, 8 << 20
KEPT_ROWS = 1 << 16  # candidates of a task between two selections of the best
DOCUMENTS, TERMS = -1, -2  # the keys of N and L beside those of the terms

#: ASCII letters and digits and all bytes of other characters are parts of terms; A-Z become a-z.
_KEPT = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats."""
    return text.translate(_KEPT).split()


class SharedSums:
    """The graph of partial sums for a block of items, each a set of term numbers.

    leaf_of: the leaf of each term; levels: arrays (left, right) of the nodes that each level adds, a
    node being the sum of two of lower levels; item_nodes: the node of each item, -1 without terms.
    """

    def __init__(self, items: list[set[int]], n_terms: int):
        holders: dict[int, list[int]] = defaultdict(list)
        for item, members in enumerate(items):
            for term in members:
                holders[term].append(item)
        leaves: dict[tuple[int, ...], int] = {}
        self.leaf_of = np.zeros(n_terms, np.int64)
        for term, held in holders.items():
            self.leaf_of[term] = leaves.setdefault(tuple(held), len(leaves))
        rows: list[list[int]] = [[] for _ in items]
        for held, leaf in sorted(leaves.items(), key=lambda e: (-len(e[0]), e[1])):
            for item in held:
                rows[item].append(leaf)
        self.n_leaves = self.n_nodes = len(leaves)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while any(len(row) > 1 for row in rows):
            rows = self._add_level(rows)
        self.item_nodes = np.array([row[0] if row else -1 for row in rows], np.int64)

    def _add_level(self, rows: list[list[int]]) -> list[list[int]]:
        """Replace neighbours by their sum: shared pairs first; without any, every other one."""
        held = Counter(pair for row in rows for pair in zip(row, row[1:]))
        least = 2 if max(held.values()) > 1 else 1
        made: dict[tuple[int, int], int] = {}
        out = []
        for row in rows:
            new, i = [], 0
            while i < len(row):
                pair = tuple(row[i:i + 2])
                following = held[tuple(row[i + 1:i + 3])] if i + 2 < len(row) else 0
                if len(pair) == 2 and held[pair] >= least and (
                        held[pair] >= following or least == 1):
                    new.append(made.setdefault(pair, self.n_nodes + len(made)))
                    i += 2
                else:
                    new.append(row[i])
                    i += 1
            out.append(new)
        self.levels.append((np.array([a for a, _ in made]), np.array([b for _, b in made])))
        self.n_nodes += len(made)
        return out

    def scores(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray,
               n_docs: int) -> np.ndarray:
        """(items, documents): sums of the values that documents have for terms."""
        sums = np.zeros((self.n_nodes + 1, n_docs), np.int64)  # the last node stays empty
        np.add.at(sums.reshape(-1), self.leaf_of[term] * n_docs + doc, value)
        at = self.n_leaves
        for left, right in self.levels:
            sums[at:at + len(left)] = sums[left] + sums[right]
            at += len(left)
        return sums[self.item_nodes]


class Block:
    """Items searched together: their terms, numbered, and the graph of their sums."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.rows = [row for row, _ in items]
        self.numbers: dict[bytes, int] = {}
        sets = [{self.numbers.setdefault(t, len(self.numbers)) for t in terms(text)}
                for _, text in items]
        self.sums = SharedSums(sets, len(self.numbers))

    def counted(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a document, and the block's terms in it with how often each occurs."""
        found = terms(text)
        known = Counter(filter(None.__ne__, map(self.numbers.get, found)))
        return (len(found), np.fromiter(known.keys(), np.int64, len(known)),
                np.fromiter(known.values(), np.int64, len(known)))


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    block, size = [], 0
    for row in items.select("row", F.encode("text", "UTF-8").alias("text")).toLocalIterator():
        if block and size + len(row["text"]) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["row"], bytes(row["text"])))
        size += len(row["text"])
    if block:
        yield block


def statistics(docs: DataFrame, block: Block) -> dict[int, int]:
    """Documents with a term (DOCUMENTS), all their terms (TERMS), and each term's documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        holding = np.zeros(len(mine.numbers), np.int64)
        documents = words = 0
        for batch in batches:
            for some in slices(batch["text"].cast(pa.binary()), SLICE_BYTES):
                for text in some:
                    n, known, _ = mine.counted(text)
                    documents += n > 0
                    words += n
                    holding[known] += 1
        seen = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([seen, [DOCUMENTS, TERMS]])),
             pa.array(np.concatenate([holding[seen], [documents, words]]))], ["key", "n"])

    summed = docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n"))
    return {row["key"]: row["n"] for row in summed.collect()}  # one for each term of the block


class Best:
    """The k best documents of each item: highest scores, then least ids, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)  # a lower score is not among the best
        self.rows = [np.zeros(0, np.int64)] * 4  # item, score, id is null, id
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.waiting.append([item, scores[item, doc], no_id[doc], ids[doc]])
        self.n_waiting += len(item)
        if self.n_waiting > KEPT_ROWS:
            self.select()

    def select(self) -> list[np.ndarray]:
        item, score, no_id, ids = map(np.concatenate, zip(self.rows, *self.waiting))
        by = np.lexsort((ids, no_id, -score, item))
        item = item[by]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = by[place < self.k]
        last = by[place == self.k - 1]
        self.rows = [np.concatenate(c)[kept] for c in zip(self.rows, *self.waiting)]
        self.least[item[place == self.k - 1]] = score[last]
        self.waiting, self.n_waiting = [], 0
        return self.rows


def _searched(docs: DataFrame, block: Block, counts: dict[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): the best k documents of each task for each item of the block."""
    n_docs, n_terms = counts[DOCUMENTS], counts[TERMS]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1)))
                        for i in range(len(block.numbers))], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((block, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, weight = shared.value
        best = Best(len(mine.rows), k)
        at_once = max(1, CELLS // (mine.sums.n_nodes + 1))
        for batch in batches:
            no_id = batch["id"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch["id"].fill_null(0).to_numpy()
            texts = batch["text"].cast(pa.binary())
            for start in range(0, len(texts), at_once):
                rows = slice(start, start + at_once)
                found = [mine.counted(text) for some in slices(
                    texts.slice(start, at_once), SLICE_BYTES) for text in some]
                n = np.array([f[0] for f in found], np.int64)
                doc = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
                term, tf = (np.concatenate([f[i] for f in found]) for i in (1, 2))
                m = 10 + 90 * n * n_docs // max(1, n_terms)
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                best.add(mine.sums.scores(term, doc, value, len(found)), no_id[rows], ids[rows])
        item, score, no_id, ids = best.select()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(mine.rows, np.int64)[item]),
             pa.array(ids, mask=no_id.astype(bool)), pa.array(score)],
            ["item", "doc_id", "score"])

    return docs.select("id", "text").mapInArrow(search, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 for each item.

    Equal scores rank by ascending doc_id, null ids last; ids are whole numbers. Null and empty texts
    have no terms: such documents are found by no item and do not count in N, such items find
    nothing. Repeated rows of either table are rows of their own. Columns may have any other names;
    empty tables give an empty result.
    """
    session = docs.sparkSession
    numbered = staged(items.select(F.col(item_id).alias("item_id"), text_or_empty(item_text).alias(
        "text")).withColumn("row", F.monotonically_increasing_id()), "items")
    read = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text).alias("text"))
    found = session.createDataFrame([], "item long, doc_id long, score long")
    for some in _blocks(numbered):
        block = Block(some)
        counts = statistics(read, block)
        if counts[DOCUMENTS] and block.numbers:
            found = found.unionByName(staged(_searched(read, block, counts, k), "found"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = best_of(found, ["item"], order, k)
    return numbered.join(best, numbered["row"] == best["item"]).select(
        F.col("item_id"), "rank", "doc_id", "score")
