"""Exact quantiles by narrowing value brackets, without ranking all values.

A quantile needs the values of one or two ranks. While many values lie in the bracket that holds a rank, a
mergeable sketch proposes splitters inside it and one counting pass says how many values lie between
them and on each of them. The counts are exact, so the bracket that holds the rank is known whatever the
sketch's error, and a value that fills a splitter is found at once. Only the few values of the last
bracket are put in order. Every pass is a grouped aggregate, combined before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Values of a bracket that one task may put in order; splitters of a pass.
MOST_INSIDE, SPLITTERS = 50_000, 64
_INSIDE = "(lo IS NULL OR _v > lo) AND (hi IS NULL OR _v < hi)"


def _few(df: DataFrame) -> DataFrame:
    """A table of at most a few rows for each group and quantile, held by the driver."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def _narrowed(rows: DataFrame, keys: list[str], targets: DataFrame, most_inside: int,
              splitters: int) -> DataFrame:
    """The targets, those in large brackets with the part that holds their rank, or with its value."""
    large = f"found IS NULL AND inside > {most_inside}"
    open_ = targets.where(large)
    brackets = F.broadcast(open_.select(*keys, "bracket", "lo", "hi").distinct())
    inner = rows.join(brackets, keys).where(_INSIDE)
    steps = [(i + 1) / (splitters + 1) for i in range(splitters)]
    split = _few(inner.groupBy(*keys, "bracket", "lo", "hi").agg(F.array_distinct(
        F.percentile_approx("_v", steps, 20 * splitters)).alias("at")))
    # cell 2p lies between the splitters p - 1 and p, cell 2p + 1 is the splitter p
    cell = F.expr("2 * size(filter(at, x -> x < _v)) + IF(array_contains(at, _v), 1, 0)")
    counted = rows.join(F.broadcast(split), keys).where(_INSIDE).groupBy(
        *keys, "bracket", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys, "bracket").orderBy("cell")) - F.col("n")
    cells = counted.withColumn("before", before).join(  # 2 * splitters + 1 rows in a bracket
        split.select(*keys, "bracket", "at"), [*keys, "bracket"])
    part = open_.join(cells, [*keys, "bracket"]).where(
        "below + before <= rank AND rank < below + before + n").selectExpr(
        *keys, "rank", f"bracket * {2 * splitters + 2} + cell AS bracket",
        "IF(cell % 2 = 0 AND cell > 0, get(at, CAST(cell / 2 AS INT) - 1), lo) AS lo",
        "IF(cell % 2 = 0, coalesce(get(at, CAST(cell / 2 AS INT)), hi), hi) AS hi",
        "below + before AS below", "n AS inside",
        "IF(cell % 2 = 1, get(at, CAST(floor(cell / 2) AS INT)), NULL) AS found")
    return _few(targets.where(f"NOT ({large})").unionByName(part))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], *,
                    most_inside: int = MOST_INSIDE, splitters: int = SPLITTERS) -> DataFrame:
    """(keys, n, a column for each name of ``quantiles``): linearly interpolated, a row for each group.

    Rows with a NULL value or key are left out; values are finite. Groups must be few, as a plot's
    panels and hues are: their brackets are held by the driver and broadcast. ``df`` is read by every pass, so it should be
    a stored table.
    """
    kept = df.where(" AND ".join(f"`{name}` IS NOT NULL" for name in [*keys, value]))
    rows = kept.select(*keys, F.col(value).cast("double").alias("_v"))
    sizes = _few(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    places = {name: f"((n - 1) * {float(q)!r}D)" for name, q in quantiles.items()}
    ranks = ", ".join(f"CAST({side}({at}) AS BIGINT)" for at in places.values()
                      for side in ("floor", "ceil"))
    targets = _few(sizes.selectExpr(
        *keys, f"explode(array_distinct(array({ranks}))) AS rank", "0L AS bracket",
        "CAST(NULL AS DOUBLE) AS lo", "CAST(NULL AS DOUBLE) AS hi", "0L AS below", "n AS inside",
        "CAST(NULL AS DOUBLE) AS found"))
    while not targets.where(f"found IS NULL AND inside > {most_inside}").isEmpty():
        targets = _narrowed(rows, keys, targets, most_inside, splitters)
    left = targets.where("found IS NULL")
    ordered = rows.join(F.broadcast(left.select(*keys, "bracket", "lo", "hi").distinct()), keys).where(
        _INSIDE).groupBy(*keys, "bracket").agg(  # most_inside values at most
            F.array_sort(F.collect_list("_v")).alias("values"))
    last = left.join(ordered, [*keys, "bracket"]).selectExpr(
        *keys, "rank", "element_at(values, CAST(rank - below AS INT) + 1) AS found")
    known = targets.where("found IS NOT NULL").select(*keys, "rank", "found").unionByName(last)
    by_rank = known.groupBy(*keys).agg(F.map_from_entries(F.collect_list(  # two for each quantile
        F.struct("rank", "found"))).alias("at"))
    low, high = ("at[CAST({side}({{0}}) AS BIGINT)]".format(side=side) for side in ("floor", "ceil"))
    return sizes.join(by_rank, keys).selectExpr(*keys, "n", *[
        f"{low} + ({high} - {low}) * ({{0}} - floor({{0}})) AS `{name}`".format(at)
        for name, at in places.items()])
