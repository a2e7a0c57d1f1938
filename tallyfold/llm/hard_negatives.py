"""Hard-negative mining by segment summary filtering.

A vector is cut into segments, and each segment's mean and deviation are stored. Over a segment of
length s the inner product of two vectors is s times the product of the means, plus or minus s times the
product of the deviations at most. The sums over segments bound a score from both sides; the
segments are halved level by level, and a row leaves as soon as its bounds show that it can't be among
the rows asked for. Only rows that no level could decide are scored exactly.

Rows are dealt into shards and anchors into blocks, both of bounded size; a cell of one shard and one
block is a task's work, and the cells' best rows are merged by rank. Positives come first; their
scores then give the range in which an anchor's negatives lie.

Within a cell, a group of anchors goes through the rows together, tile by tile in order of ids: the bounds
and scores of a tile are matrix products. What a row must score rises with the rows found so far, and
a row leaves a tile when its bounds rule it out for all anchors of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import best_of, parts, staged

#: Rows of a small part, most parts, rows of the largest part.
SHARDS, BLOCKS = (800, 12, 1 << 16), (8_192, 16, 8_192)
#: Anchors of a group, how many of them are asked first whether they need a row, rows of the first and
#: of the largest tile.
GROUP, FEW, TILES = 128, 8, (32, 2_048)
SMALLEST_SEGMENT = 4
#: Rounding of the bounds stays far below half a unit for scores below 2 ** 50.
SLACK = 0.5


def levels(size: int) -> list[np.ndarray]:
    """The segments' starts, level by level; each level halves the segments of the one before."""
    out, n = [], 1
    while n == 1 or size >= n * SMALLEST_SEGMENT:
        out.append(np.arange(n) * size // n)
        n *= 2
    return out if size else []


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of all segments of all levels, each times the root of its length."""
    size = vectors.shape[1]
    means, deviations = [np.zeros((len(vectors), 0))], [np.zeros((len(vectors), 0))]
    for starts in levels(size):
        length = np.diff(np.append(starts, size))
        mean = np.add.reduceat(vectors, starts, axis=1) / length
        apart = vectors - np.repeat(mean, length, axis=1)
        means.append(mean * np.sqrt(length))
        deviations.append(np.sqrt(np.add.reduceat(apart * apart, starts, axis=1)))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _matrix(lists: pa.Array) -> np.ndarray:
    """One row for each list, missing elements at the end as zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values, longest = lists.flatten().to_numpy(zero_copy_only=False), int(sizes.max(initial=0))
    if (sizes == longest).all():
        return values.reshape(len(sizes), longest)
    out = np.zeros((len(sizes), longest))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(ends, np.ascontiguousarray(rows, np.float64).ravel())


def summarised(vectors: DataFrame, id_column: str, vector: str, label: str | Column) -> DataFrame:
    """(row, id, label, vector, means, deviations) of the rows that take part, whole-number vectors."""
    label = F.col(label) if isinstance(label, str) else label
    kept = vectors.select(
        F.col(id_column).cast("long").alias("id"), label.cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector")).where(
            "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> "
            "coalesce(x > double('-Infinity') AND x < double('Infinity'), false))")
    whole = kept.select("id", "label", F.expr("transform(vector, x -> CAST(floor(256D * x) AS DOUBLE))")
                        .alias("vector"))
    size = whole.agg(F.max(F.size("vector"))).first()[0] or 0

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch["vector"])
            rows = np.pad(rows, ((0, 0), (0, size - rows.shape[1])))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], *map(_lists, (rows, *summaries(rows)))],
                ["id", "label", "vector", "means", "deviations"])

    made = whole.mapInArrow(summarise, "id long, label string, vector array<double>, "
                                       "means array<double>, deviations array<double>")
    return made.withColumn("row", F.monotonically_increasing_id())


class Rows:
    """Vectors with their summaries, level by level, in order of ids."""

    def __init__(self, table: pa.Table):
        self.row, self.id = table["row"].to_numpy(), table["id"].to_numpy()
        labels = table["label"].combine_chunks().dictionary_encode()
        self.label, self.labels = labels.indices.to_numpy(), labels.dictionary.to_pylist()
        self.vector, self.means, self.deviations = (
            _matrix(table[c].combine_chunks()) for c in ("vector", "means", "deviations"))
        ends = np.cumsum([len(starts) for starts in levels(self.vector.shape[1])])
        self.levels = [slice(a, b) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def labels_of(self, other: "Rows") -> np.ndarray:
        """The labels of the other rows by their numbers here, -1 for those that no row here has."""
        number = {label: i for i, label in enumerate(self.labels)}
        return np.array([number.get(label, -1) for label in other.labels], np.int64)[other.label]

    def bounds(self, level: slice, rows: np.ndarray, other: "Rows", at: np.ndarray):
        """(least, most) scores of the rows with some rows of ``other``, by this level's segments."""
        middle = self.means[rows, level] @ other.means[at, level].T
        apart = self.deviations[rows, level] @ other.deviations[at, level].T + SLACK
        return middle - apart, middle + apart

    def score(self, rows: np.ndarray, other: "Rows", at: np.ndarray) -> np.ndarray:
        return np.rint(self.vector[rows] @ other.vector[at].T).astype(np.int64)


Wanted = Callable[[np.ndarray, np.ndarray], np.ndarray]


def first_rows(shard: Rows, rows: np.ndarray, anchors: Rows, at: np.ndarray, low: np.ndarray,
               high: np.ndarray, k: int, wanted: Wanted) -> tuple[np.ndarray, ...]:
    """(place in ``at``, range, row, score): the first k rows for each anchor and range of scores.

    low, high: a row for each anchor, a column for each range. wanted: which pairs of a row and a
    place in ``at`` count. Once k rows are known, one of a greater id has to score higher than the k-th.
    """
    place, range_, found, score = (np.zeros(0, np.int64) for _ in range(4))
    floor, highest, start, size = low.copy(), high.max(axis=1), 0, TILES[0]
    while start < len(rows):
        tile, lowest = rows[start:start + size], floor.min(axis=1)
        start, size = start + size, min(2 * size, TILES[1])
        for level in shard.levels:
            stays = np.zeros(len(tile), bool)
            for some in (slice(FEW), slice(FEW, None)):  # a row that one anchor needs stays
                open_ = np.flatnonzero(~stays)
                least, most = shard.bounds(level, tile[open_], anchors, at[some])
                stays[open_] = ~((most < lowest[some]) | (least > highest[some])).all(axis=1)
            tile = tile[stays]
        scores = shard.score(tile, anchors, at)
        r, a = np.nonzero((scores >= lowest) & (scores <= highest))
        pairs = wanted(tile[r], a)
        r, a = r[pairs], a[pairs]
        exact = scores[r, a]
        pair, i = np.nonzero((exact[:, None] >= floor[a]) & (exact[:, None] <= high[a]))
        place, range_ = np.concatenate([place, a[pair]]), np.concatenate([range_, i])
        found, score = np.concatenate([found, tile[r[pair]]]), np.concatenate([score, exact[pair]])
        by = np.lexsort((found, -score, range_, place))
        key = place[by] * low.shape[1] + range_[by]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        last = by[rank == k - 1]
        floor[place[last], range_[last]] = score[last] + 1
        place, range_, found, score = (x[by[rank < k]] for x in (place, range_, found, score))
    return place, range_, found, score


def _groups(at: np.ndarray) -> list[np.ndarray]:
    return [at[i:i + GROUP] for i in range(0, len(at), GROUP)]


def _joined(parts_: list[tuple[np.ndarray, ...]], columns: int) -> list[np.ndarray]:
    return [*map(np.concatenate, zip((np.zeros(0, np.int64),) * columns, *parts_))]


def positives(shard: Rows, anchors: Rows, at: int | np.ndarray, k: int) -> list[np.ndarray]:
    """(anchor, row, score): the first k rows of the shard with each anchor's label, itself left out."""
    at, labels, out = np.atleast_1d(at), shard.labels_of(anchors), []
    for label in np.unique(labels[at]):
        rows = np.flatnonzero(shard.label == label)
        for some in _groups(at[labels[at] == label]):
            every = np.iinfo(np.int64)
            low, high = np.full((len(some), 1), every.min), np.full((len(some), 1), every.max)
            place, _, found, score = first_rows(
                shard, rows, anchors, some, low, high, k,
                lambda r, a: shard.row[r] != anchors.row[some[a]])
            out.append((some[place], found, score))
    return _joined(out, 3)


def negatives(shard: Rows, anchors: Rows, ranges: list[list[tuple[int, int]]],
              k: int) -> list[np.ndarray]:
    """(anchor, range, row, score): for each of an anchor's ranges of scores (low, high) the first k
    rows of other labels."""
    every, labels, out = np.iinfo(np.int64), shard.labels_of(anchors), []
    low = np.full((len(ranges), max(map(len, ranges), default=0)), every.max)
    high = np.full(low.shape, every.min)  # no score lies in a range that isn't there
    for at, own in enumerate(ranges):
        for i, (least, most) in enumerate(own):
            if least <= most:
                low[at, i], high[at, i] = least, most
    rows, at = np.arange(len(shard.row)), np.argsort(labels, kind="stable")
    for some in _groups(at if low.size else at[:0]):
        place, range_, found, score = first_rows(
            shard, rows, anchors, some, low[some], high[some], k,
            lambda r, a: shard.label[r] != labels[some[a]])
        out.append((some[place], range_, found, score))
    return _joined(out, 4)


def _cells(rows: DataFrame, anchors: DataFrame, shard_sizes: tuple, block_sizes: tuple) -> DataFrame:
    """Every shard of the rows beside every block of the anchors (anchor: true)."""
    shards, blocks = parts(rows.count(), *shard_sizes), parts(anchors.count(), *block_sizes)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def of(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    empty = F.lit(None).cast(anchors.schema["scores"].dataType).alias("scores")
    dealt = rows.select(of(shards).alias("shard"), every(blocks).alias("block"),
                        F.lit(False).alias("anchor"), *rows.columns, empty)
    asked = anchors.select(every(shards).alias("shard"), of(blocks).alias("block"),
                           F.lit(True).alias("anchor"), *rows.columns, "scores")
    return dealt.unionByName(asked).repartition(shards * blocks, "shard", "block").groupBy(
        "shard", "block")


def _both(cell: pa.Table) -> tuple[Rows, Rows, pa.Table]:
    cell = cell.sort_by("id")
    asked = cell.filter(cell["anchor"])
    return Rows(cell.filter(pc.invert(cell["anchor"]))), Rows(asked), asked


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id",
                   vector: str = "embedding", label: str | Column = "label", n_positives: int = 5,
                   n_negatives: int = 10, percent: tuple[int, int] = (30, 90),
                   shard_sizes: tuple = SHARDS, block_sizes: tuple = BLOCKS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    is_anchor: a condition on the column ``id``. An anchor's positives are its first ``n_positives``
    other rows of its label; its negatives for a positive are the first ``n_negatives`` rows of other
    labels whose score lies between the two percentages of the positive's. Highest scores come
    first, ties by the lesser id. A score is the inner product of the components' floor(256 * x),
    exact below 2 ** 50. Rows without id, label or vector, or with a null or non-finite component,
    take no part. Shorter vectors count as ending in zeros; repeated ids are rows of their own, so
    the other row of an id can be its positive. Empty tables give an empty result.
    """
    rows = staged(summarised(vectors, id_column, vector, label), "rows")
    anchors = rows.where(is_anchor)

    def find_positives(cell: pa.Table) -> pa.Table:
        shard, asked, _ = _both(cell)
        anchor, row, score = positives(shard, asked, np.arange(len(asked.row)), n_positives)
        return pa.table({"anchor": asked.row[anchor], "positive_id": shard.id[row], "score": score})

    near = _cells(rows, anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), shard_sizes,
                  block_sizes).applyInArrow(
        find_positives, "anchor long, positive_id long, score long")
    chosen = staged(best_of(near, ["anchor"], [F.col("score").desc(), F.col("positive_id")],
                            n_positives), "positives")
    low, high = percent
    wanted = chosen.groupBy("anchor").agg(F.expr(  # n_positives at most
        "transform(array_sort(collect_list(struct(rank, score))), s -> s.score)").alias("scores"))

    def find_negatives(cell: pa.Table) -> pa.Table:
        shard, asked, table = _both(cell)
        ranges = [[(-(-low * s // 100), high * s // 100) for s in scores]
                  for scores in table["scores"].to_pylist()]
        anchor, place, row, score = negatives(shard, asked, ranges, n_negatives)
        return pa.table({"anchor": asked.row[anchor], "place": place + 1,
                         "negative_id": shard.id[row], "negative_score": score})

    asked = anchors.join(wanted, anchors["row"] == wanted["anchor"]).select(*rows.columns, "scores")
    far = _cells(rows, asked, shard_sizes, block_sizes).applyInArrow(
        find_negatives, "anchor long, place long, negative_id long, negative_score long")
    best = best_of(far, ["anchor", "place"], [F.col("negative_score").desc(), F.col("negative_id")],
                   n_negatives)
    listed = chosen.select("anchor", F.col("rank").alias("place"), "positive_id",
                           F.col("score").alias("positive_score"))
    return (best.join(listed, ["anchor", "place"])
            .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")),
                  "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
