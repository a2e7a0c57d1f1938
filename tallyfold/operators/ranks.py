"""Exact ranks from value histograms: the shared core of U, ties, medians and quartiles.

Ranking inside a few very large groups would give each group to one task. Here equal values are
first combined into a histogram (map-side), which is written once and read by whatever ranks it.
Its rows are dealt by range of (group, value), as a sort deals them, into as many ranges as their
number asks for, up to MOST_RANGES; rows are counted inside each range in parallel and shifted by the totals of the
group's ranges before it. Where a range ends only decides which task counts what.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators.skew import parts_of
from tallyfold.sources.tables import staged

ROWS_PER_RANGE = 2_000_000
#: Each range is a partition of a shuffle, so there are no more ranges than that, unless a range would hold
#: more than ROWS_PER_RANGE rows.
MOST_RANGES = 2_000


def ranges_of(rows: int, rows_per_range: int) -> int:
    """Ranges to deal so many rows into: smaller ones than asked for cost tasks and save nothing."""
    return max(1, min(-(-rows // rows_per_range), max(MOST_RANGES, -(-rows // ROWS_PER_RANGE))))


def histogram(df: DataFrame, keys: list[str], value: str, counts: dict[str, str]) -> DataFrame:
    """One row per (keys, value) with ``n_<name>`` rows of each named condition, as a stored table.

    NULL values and NULL keys are left out.
    """
    kept = df.where(" AND ".join(f"`{name}` IS NOT NULL" for name in [*keys, value]))
    return staged(kept.groupBy(*keys, value).agg(
        *[F.expr(f"count_if({condition})").alias(f"n_{name}")
          for name, condition in counts.items()]), "histogram")


def ranked(hist: DataFrame, keys: list[str], value: str, rows_per_range: int = ROWS_PER_RANGE, *,
           keep_range: bool = False) -> DataFrame:
    """A stored histogram with exact cumulative counts for each of its ``n_<name>`` columns.

    For each name: ``before_`` (rows below the value), ``total_`` (rows in the group) and ``mean_``.
    ``keep_range``: also ``_range``, the number of the range of (group, value) that a row lies in.
    """
    names = [c[2:] for c in hist.columns if c.startswith("n_")]
    v, group = f"`{value}`", ", ".join(f"`{k}`" for k in keys)
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    rows = hist.count()
    ranges = ranges_of(rows, rows_per_range)
    if ranges == 1:  # nothing to shift
        one = ["0 AS _range"] if keep_range else []
        return hist.selectExpr("*", *one, *[column for name in names for column in (
            f"sum(n_{name}) OVER (PARTITION BY {group} ORDER BY {v} {so_far}) - n_{name} "
            f"AS before_{name}",
            f"sum(n_{name}) OVER (PARTITION BY {group}) AS total_{name}",
            f"try_divide(sum(n_{name} * {v}) OVER (PARTITION BY {group}), "
            f"sum(n_{name}) OVER (PARTITION BY {group})) AS mean_{name}")])
    # stored, since a range partitioning that is made anew may cut elsewhere
    ranged = hist.repartitionByRange(ranges, *keys, value).withColumn("_range", F.spark_partition_id())
    tasks = parts_of(hist.sparkSession, rows, ROWS_PER_RANGE)
    ranged = staged(ranged.coalesce(tasks) if tasks < ranges else ranged, "ranges")
    local = ranged.selectExpr("*", *[
        f"sum(n_{name}) OVER (PARTITION BY {group}, _range ORDER BY {v} {so_far}) - n_{name} "
        f"AS _local_{name}" for name in names])
    sums = ranged.groupBy(*keys, "_range").agg(*[column for name in names for column in (
        F.expr(f"sum(n_{name})").alias(f"_rows_{name}"),
        F.expr(f"sum(n_{name} * {v})").alias(f"_sum_{name}"))])
    # one row per range and group from here on
    offsets = sums.selectExpr(*keys, "_range", *[column for name in names for column in (
        f"sum(_rows_{name}) OVER (PARTITION BY {group} ORDER BY _range {so_far}) - _rows_{name} "
        f"AS _offset_{name}",
        f"sum(_rows_{name}) OVER (PARTITION BY {group}) AS total_{name}",
        f"try_divide(sum(_sum_{name}) OVER (PARTITION BY {group}), "
        f"sum(_rows_{name}) OVER (PARTITION BY {group})) AS mean_{name}")])
    return local.join(offsets, [*keys, "_range"]).selectExpr(
        *[f"`{k}`" for k in keys], v, *(["_range"] if keep_range else []),
        *[f"n_{name}" for name in names],
        *[column for name in names for column in (
            f"_local_{name} + _offset_{name} AS before_{name}", f"total_{name}",
            f"mean_{name}")])


def ranked_histogram(df: DataFrame, keys: list[str], value: str, counts: dict[str, str], *,
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``ranked`` over the ``histogram`` of rows; ``counts`` maps names to SQL conditions."""
    return ranked(histogram(df, keys, value, counts), keys, value, rows_per_range)


def quantile(value: str, name: str, q: float) -> Column:
    """Aggregate over a ranked histogram: linearly interpolated quantile of the named rows.

    The value at a rank is the smallest one whose cumulative count reaches it.
    """
    position = f"((total_{name} - 1) * {float(q)!r}D)"
    low, high = (f"min(IF(before_{name} + n_{name} >= {side}({position}) + 1, {value}, NULL))"
                 for side in ("floor", "ceil"))
    return F.expr(f"{low} + ({high} - {low}) * max({position} - floor({position}))")
