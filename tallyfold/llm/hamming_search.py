"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, each with a bucket index. A row at distance below segments * (r + 1)
has a segment at distance r or less, so probing all segment values within radius r finds every such
row. The radius grows, for each query on its own, until the distance of its verified k-th neighbour
is covered. Rows and distinct query codes are dealt into shards and blocks of bounded size; a cell of
one shard and one block is a task's work, and the cells' k best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import parts, staged

BITS, SEGMENT_BITS = 64, 16
#: Rows of a small part, most parts, rows of the largest part.
SHARDS, BLOCKS = (10_000, 32, 1 << 20), (1_024, 16, 1 << 15)
QUERIES_AT_ONCE_ROWS = 4 << 20  # queries searched together times rows of the shard


def sign_codes(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, code): bit i of the code is set where element i (of 64 at most) is positive.

    Rows without id or vector are left out; null and NaN elements are no positive ones.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            if (sizes > BITS).any():
                raise ValueError(f"vectors of more than {BITS} elements")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            bit = np.arange(len(values)) - np.repeat(starts, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            bits = np.zeros((len(sizes), BITS), np.uint8)
            bits[row, bit] = values > 0
            codes = np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(codes)], ["id", "code"])

    kept = vectors.select(F.col(id_column).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("vector"))
    return kept.where("id IS NOT NULL AND vector IS NOT NULL").mapInArrow(
        encode, "id long, code long")


class SegmentIndex:
    """Bucket indexes of 64-bit codes, one for each segment."""

    def __init__(self, codes: np.ndarray):
        self.parts = codes.view(np.uint16).reshape(-1, BITS // SEGMENT_BITS)
        self.codes, self.segments = codes, self.parts.shape[1]
        self.order, self.offsets = [], []
        for s in range(self.segments):
            self.order.append(np.argsort(self.parts[:, s], kind="stable"))
            counts = np.bincount(self.parts[:, s], minlength=1 << SEGMENT_BITS)
            self.offsets.append(np.concatenate([[0], np.cumsum(counts)]))
        self.masks: dict[int, np.ndarray] = {}

    def probe(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs whose nearest segment is at exactly ``radius``, each pair once."""
        if radius not in self.masks:
            self.masks[radius] = np.array(
                [sum(1 << b for b in bits) for bits in combinations(range(SEGMENT_BITS), radius)],
                np.uint16)
        parts = queries.view(np.uint16).reshape(-1, self.segments)
        which, rows = [], []
        for s in range(self.segments):
            values = (parts[:, s, None] ^ self.masks[radius][None, :]).ravel().astype(np.int64)
            low, found = self.offsets[s][values], np.diff(self.offsets[s])[values]
            query = np.repeat(np.repeat(np.arange(len(queries)), len(self.masks[radius])), found)
            at = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
            row = self.order[s][np.repeat(low, found) + at]
            gaps = np.bitwise_count(parts[query] ^ self.parts[row])
            first = (gaps[:, :s] > radius).all(axis=1) & (gaps[:, s + 1:] >= radius).all(axis=1)
            which.append(query[first])
            rows.append(row[first])
        return np.concatenate(which), np.concatenate(rows)

    def nearest(self, queries: np.ndarray, ids: np.ndarray, k: int):
        """(query, id, distance) of the k nearest rows of each query, ties by id."""
        n = len(queries)
        query, row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        distance = np.zeros(0, np.int64)
        counts = np.zeros((n, BITS + 1), np.int64)
        open_ = np.arange(n)
        for radius in range(SEGMENT_BITS + 1):
            q, r = self.probe(queries[open_], radius)
            q = open_[q]
            d = np.bitwise_count(queries[q] ^ self.codes[r]).astype(np.int64)
            np.add.at(counts, (q, d), 1)
            reached = counts.cumsum(axis=1) >= k
            kth = np.where(reached.any(axis=1), reached.argmax(axis=1), BITS)
            query, row = np.concatenate([query, q]), np.concatenate([row, r])
            distance = np.concatenate([distance, d])
            near = distance <= kth[query]
            query, row, distance = query[near], row[near], distance[near]
            open_ = open_[kth[open_] >= self.segments * (radius + 1)]
            if not len(open_):
                break
        by = np.lexsort((ids[row], distance, query))
        query, row, distance = query[by], row[by], distance[by]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < k
        return query[best], ids[row[best]], distance[best]


def top_k(codes: DataFrame, is_query, k: int = 10, shard_sizes: tuple = SHARDS,
          block_sizes: tuple = BLOCKS) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest of all rows for each query row.

    codes: (id, code) without nulls, as ``sign_codes`` gives. A query is a row itself and its own
    neighbour at distance 0. Ties go to the lesser id; repeated ids are rows of their own, and with
    fewer than k rows all are given. Of rows with one code only the k least ids can be neighbours
    (the group limit runs before the shuffle), and equal query codes are searched once.
    """
    codes = staged(codes, "codes")
    queries = codes.where(is_query)
    least = Window.partitionBy("code").orderBy("id")
    rows = codes.withColumn("place", F.row_number().over(least)).where(
        F.col("place") <= k).select("code", "id")
    asked = staged(queries.select("code").distinct(), "asked")
    shards, blocks = parts(codes.count(), *shard_sizes), parts(asked.count(), *block_sizes)
    shard, block = F.pmod(F.xxhash64("code", "id"), F.lit(shards)), F.pmod(
        F.xxhash64("code"), F.lit(blocks))
    dealt = rows.select(
        shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "code", "id").unionByName(asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            block.alias("block"), "code", F.lit(None).cast("long").alias("id")))

    def search(cell: pa.Table) -> pa.Table:
        code = cell["code"].to_numpy().view(np.uint64)
        asks = cell["id"].is_null().to_numpy(zero_copy_only=False)
        ids = cell["id"].filter(cell["id"].is_valid()).to_numpy()
        found = [(np.zeros(0, np.int64),) * 3]
        if len(ids) and asks.any():
            index, wanted = SegmentIndex(code[~asks].copy()), code[asks]
            at_once = max(1, QUERIES_AT_ONCE_ROWS // len(ids))
            for i in range(0, len(wanted), at_once):
                some = wanted[i:i + at_once].copy()
                q, n, d = index.nearest(some, ids, k)
                found.append((some[q].view(np.int64), n, d))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(("code", "neighbor_id", "distance"), columns)))

    near = dealt.repartition(shards * blocks, "shard", "block").groupBy("shard", "block").applyInArrow(
        search, "code long, neighbor_id long, distance long")
    order = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return queries.join(best, "code").select(
        F.col("id").alias("query_id"), "rank", "neighbor_id", "distance")
