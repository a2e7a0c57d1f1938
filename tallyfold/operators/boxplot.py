"""Box-plot data: quartiles, whiskers and outliers per component and response group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.functions.scalars import component_rank, fixed_decimals, lookup_label
from tallyfold.operators.quantiles import MOST_INSIDE, exact_quantiles
from tallyfold.operators.ranks import quantile
from tallyfold.sources.tables import staged
from tallyfold.study import TIME, Study

WHISKER_REACH = 1.5


def boxplot_input(cohort: DataFrame, study: Study) -> DataFrame:
    """The plotted columns of the cohort rows, with display labels."""
    return cohort.select(
        "population", "percentage", "response", TIME,
        lookup_label(F.col("response"), study.group_labels).alias("response_label"))


def _fenced(quartiles: DataFrame) -> DataFrame:
    return quartiles.selectExpr("*", f"q1 - {WHISKER_REACH}D * (q3 - q1) AS _low",
                                f"q3 + {WHISKER_REACH}D * (q3 - q1) AS _high")


def _boxes(ranks: DataFrame, keys: list[str]) -> DataFrame:
    return _fenced(ranks.groupBy(*keys).agg(
        F.max("total_all").alias("n"), quantile("_value", "all", 0.25).alias("q1"),
        quantile("_value", "all", 0.5).alias("median"), quantile("_value", "all", 0.75).alias("q3")))


def _box_tables(ranks: DataFrame, names: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(summary, outliers) from a ranked histogram of ``_value`` with the rows named ``all``."""
    return _against_boxes(ranks, _boxes(ranks, names), names, value)


def _against_boxes(rows: DataFrame, boxes: DataFrame, names: list[str],
                   value: str) -> tuple[DataFrame, DataFrame]:
    """(summary, outliers) of rows (names, _value, n_all), one box for each listed key tuple."""
    against = rows.select(*names, "_value", "n_all").join(F.broadcast(boxes), names)
    inside = "_value BETWEEN _low AND _high"
    summary = (
        against.groupBy(*names)
        .agg(*[F.max(c).alias(c) for c in ("n", "q1", "median", "q3")],
             F.expr("min(IF(_value >= _low, _value, NULL))").alias("_lowest"),
             F.expr("max(IF(_value <= _high, _value, NULL))").alias("_highest"),
             F.expr(f"sum(IF({inside}, 0, n_all))").alias("n_outliers"))
        .selectExpr(*names, "n", "least(_lowest, q1) AS whisker_low", "q1", "median", "q3",
                    "greatest(_highest, q3) AS whisker_high", "n_outliers"))
    outliers = against.where(f"NOT ({inside})").groupBy(
        *names, F.col("_value").alias(value)).agg(F.sum("n_all").alias("n"))
    return summary, outliers


def boxplot_tables(df: DataFrame, keys: dict[str, list], value: str, *,
                   most_inside: int = MOST_INSIDE) -> tuple[DataFrame, DataFrame]:
    """(summary, outliers) of ``value`` per key tuple.

    ``keys`` maps each key column to the values drawn, as a plot lists its panels and hues; other
    rows are left out. So the boxes number at most the product of the list lengths and can be
    broadcast back to the rows. Quartiles are selected exactly without ranking the rows, and
    interpolate linearly; whiskers end at the last value within 1.5 times the interquartile range,
    never inside the box; ``outliers`` has one row per distinct value beyond them, with its number of
    rows.
    """
    names = list(keys)
    drawn = df.where(F.col(value).isNotNull())
    for name, listed in keys.items():
        drawn = drawn.where(F.col(name).isin(list(listed)))
    rows = staged(drawn.select(*names, F.col(value).cast("double").alias("_value")), "values")
    quartiles = exact_quantiles(rows, names, "_value", {"q1": 0.25, "median": 0.5, "q3": 0.75},
                                most_inside=most_inside)
    counted = rows.withColumn("n_all", F.lit(1).cast("bigint"))
    return _against_boxes(counted, _fenced(quartiles), names, value)


def _labelled(table: DataFrame, study: Study) -> DataFrame:
    """Groups get their label at the end, on the few result rows."""
    label = lookup_label(F.col("response"), study.group_labels).alias("response_label")
    return table.select(*[label if name == "response" else name for name in table.columns])


def study_boxes(cohort: DataFrame, study: Study, by_time: bool = False,
                **options) -> tuple[DataFrame, DataFrame]:
    """Box-plot tables of a study's cohort rows, optionally per time point."""
    keys: dict[str, list] = {"population": list(study.components)}
    if by_time:
        keys[TIME] = list(study.timepoints)
    keys["response"] = list(study.groups)
    summary, outliers = boxplot_tables(cohort, keys, "percentage", **options)
    return _labelled(summary, study), _labelled(outliers, study)


def boxes_of_ranks(ranks: DataFrame, study: Study,
                   by_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same from the ranked histogram by scope that the statistics use."""
    names = ["population", *([TIME] if by_time else []), "response"]
    scopes = ranks.where("scope <> 'pooled'" if by_time else "scope = 'pooled'").withColumn(
        TIME, F.expr("try_cast(substring(scope, 3) AS INT)"))
    sides = [scopes.where(f"n_{side} > 0").select(
        *names[:-1], F.lit(group).alias("response"), "_value",
        *[F.col(f"{what}_{side}").alias(f"{what}_all") for what in ("n", "before", "total", "mean")])
        for side, group in zip("ab", study.groups)]
    summary, outliers = _box_tables(sides[0].unionByName(sides[1]), names, "percentage")
    return _labelled(summary, study), _labelled(outliers, study)


def annotate(summary: DataFrame, stats: DataFrame, study: Study) -> DataFrame:
    """Add panel title, adjusted p-values and the significance marker of each component.

    ``stats`` is one scope: a row per component, so the joined side is as small as the list.
    """
    notes = stats.select(
        "population", "mwu_p_bh", "t_p_bh",
        F.when(F.col("significant_primary"), "**").otherwise("ns").alias("marker"))
    return (summary.join(F.broadcast(notes), "population", "left")
            .withColumn("title", lookup_label(F.col("population"), study.labels,
                                              F.col("population"))))


def boxplot_order(study: Study, by_time: bool = False) -> list:
    ranks = [component_rank(F.col("population"), study.components)]
    if by_time:
        ranks.append(F.col(TIME))
    return ranks + [component_rank(F.col("response_label"), study.group_labels.values())]


def formatted_stats(stats: DataFrame) -> DataFrame:
    """Statistics as shown: p-values with four decimals, effects with three."""
    decimals = {"mwu_p_bh": 4, "t_p_bh": 4, "mwu_p_raw": 4, "t_p_raw": 4,
                "rank_biserial": 3, "mean_difference": 3, "median_difference": 3}
    return stats.select(*[
        fixed_decimals(F.col(c), decimals[c]).alias(c) if c in decimals else F.col(c)
        for c in stats.columns])
