"""Benjamini-Hochberg adjustment and significance flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.operators.ranks import ROWS_PER_RANGE, ranked
from tallyfold.operators.skew import lookup_join
from tallyfold.sources.tables import staged


def _adjusted_values(rows: DataFrame, p: str, rows_per_range: int) -> DataFrame:
    """(_family, _p, _adjusted) of every distinct p-value of rows (_family, p).

    The adjusted value of p is the least p' * m / rank(p') over the family's p' from p on, where the
    rank of a repeated value is that of its last row. Distinct values are ranked by ranges of
    (family, p); each range takes its running minimum from its largest value down, and the
    minimum of the ranges after it is carried over.
    """
    hist = staged(rows.where(f"`{p}` IS NOT NULL").groupBy(
        "_family", F.col(p).cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("n_all")), "histogram")
    scaled = staged(ranked(hist, ["_family"], "_p", rows_per_range, keep_range=True).selectExpr(
        "_family", "_p", "_range",
        "_p / (CAST(before_all + n_all AS DOUBLE) / total_all) AS _scaled"), "scaled")
    later = scaled.groupBy("_family", "_range").agg(F.min("_scaled").alias("_least")).selectExpr(
        "_family", "_range", "min(_least) OVER (PARTITION BY _family ORDER BY _range DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _later")  # one row for each range
    own = scaled.selectExpr(
        "_family", "_p", "_range", "min(_scaled) OVER (PARTITION BY _family, _range ORDER BY _p DESC "
        "ROWS UNBOUNDED PRECEDING) AS _own")
    return own.join(later, ["_family", "_range"]).selectExpr(
        "_family", "_p", "least(1D, _own, _later) AS _adjusted")


def bh_adjust_families(df: DataFrame, family: list[str], p_columns: dict[str, str], *,
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``bh_adjust`` for families of any size: no task holds a family.

    The rows are written once. A NULL in a family key is a value like any other; a NULL p stays
    NULL and does not count towards the family's size.
    """
    out = staged(df.withColumn("_family", F.struct(*family)), "rows")
    for i, (p, adjusted) in enumerate(p_columns.items()):
        key = f"_key_{i}"
        values = _adjusted_values(out.select("_family", p), p, rows_per_range)
        lookup = staged(values.select(F.struct("_family", "_p").alias(key),
                                      F.col("_adjusted").alias(adjusted)), "adjusted")
        keyed = out.withColumn(key, F.when(
            F.col(p).isNotNull(), F.struct("_family", F.col(p).cast("double").alias("_p"))))
        out = lookup_join(keyed, lookup, key, "left").drop(key)
    return out.select(*df.columns, *p_columns.values())


def bh_adjust(df: DataFrame, family: list[str], p_columns: dict[str, str]) -> DataFrame:
    """Add one adjusted column per (raw column -> adjusted column) entry.

    Running minimum of p / (i / m) from the largest p down, capped at 1. For families bounded by a
    list, such as a scope's components: a family is one task, and all windows share the one
    partitioning. A NULL p stays NULL and does not count towards m.
    """
    within = "PARTITION BY " + ", ".join(f"`{name}`" for name in family)
    out = df.selectExpr("*", *[
        f"{p} / (CAST(row_number() OVER ({within} ORDER BY {p} NULLS LAST) AS DOUBLE) "
        f"/ nullif(count({p}) OVER ({within}), 0)) AS _scaled_{i}"
        for i, p in enumerate(p_columns)])
    return out.selectExpr(*[f"`{name}`" for name in df.columns], *[
        f"IF({p} IS NULL, NULL, least(1D, min(_scaled_{i}) OVER ({within} "
        f"ORDER BY {p} DESC NULLS FIRST, _scaled_{i} ROWS UNBOUNDED PRECEDING))) AS {adjusted}"
        for i, (p, adjusted) in enumerate(p_columns.items())])


def significance_flags(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Primary: rank test below alpha. High confidence: both tests below alpha (strictly)."""
    rank_test = f"coalesce(mwu_p_bh < {alpha}D, false)"
    return df.selectExpr(
        "*", f"{rank_test} AS significant_primary",
        f"{rank_test} AND coalesce(t_p_bh < {alpha}D, false) AS significant_high_confidence")


def flagged(df: DataFrame, flag: str = "significant_primary") -> DataFrame:
    return df.where(flag)
