"""Two-group comparisons: group sizes, locations, Welch's t, Mann-Whitney U and effect size.

Everything is read off one ranked histogram per (scope, component), so all scopes and
components are compared in a single pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.functions.scalars import component_rank
from tallyfold.functions.tails import exact_rank_sum_p, normal_sf, student_t_two_sided
from tallyfold.operators.cohort import scopes_of_row
from tallyfold.operators.fdr import bh_adjust, significance_flags
from tallyfold.operators.ranks import (
    ROWS_PER_RANGE, histogram, quantile, ranked, ranked_histogram)
from tallyfold.sources.tables import staged
from tallyfold.study import STATS_COLUMNS, TIME, Study

# Fixed value: the common default of rank-sum tests for using the exact distribution.
EXACT_UP_TO = 8
SCOPE_KEYS = ["scope", "population"]


def group_summary(ranks: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key, from a ranked histogram of the named rows ``a`` and ``b``: sizes, means, medians,
    variances, 2U of ``a`` and the tie sum. 2U is an integer, held exactly up to 2**53."""
    tied = "CAST(n_a + n_b AS DOUBLE)"
    out = {}
    for name in ("a", "b"):
        out[f"n_{name}"] = F.expr(f"max(total_{name})")
        out[f"median_{name}"] = quantile(value, name, 0.5)
        out[f"mean_{name}"] = F.expr(f"max(mean_{name})")
        out[f"variance_{name}"] = F.expr(
            f"try_divide(sum(n_{name} * ({value} - mean_{name}) * ({value} - mean_{name})), "
            f"max(total_{name}) - 1)")
    out["u_doubled"] = F.expr("sum(CAST(n_a AS DOUBLE) * (2D * before_b + n_b))")
    out["tie_sum"] = F.expr(f"sum({tied} * {tied} * {tied} - {tied})")
    out["largest_tie"] = F.expr("max(n_a + n_b)")
    return ranks.groupBy(*keys).agg(*[column.alias(name) for name, column in out.items()])


def welch_t(summary: DataFrame) -> DataFrame:
    """Add ``t_stat``, ``t_df`` and ``t_p_raw`` (unequal variances, two-sided).

    With no variance in either group t is infinite for different means and NULL for equal ones;
    a group of fewer than two rows gives NULL.
    """
    return summary.selectExpr(
        "*", "IF(n_a > 1, variance_a / n_a, NULL) AS _sa", "IF(n_b > 1, variance_b / n_b, NULL) AS _sb",
    ).selectExpr(
        "*",
        """CASE WHEN _sa + _sb > 0 THEN (mean_a - mean_b) / sqrt(_sa + _sb)
                WHEN _sa + _sb = 0 AND mean_a <> mean_b
                THEN signum(mean_a - mean_b) * double('Infinity') END AS t_stat""",
        """CASE WHEN _sa + _sb > 0 THEN (_sa + _sb) * (_sa + _sb)
                  / (_sa * _sa / (n_a - 1) + _sb * _sb / (n_b - 1))
                WHEN _sa + _sb = 0 THEN 1D END AS t_df""",
    ).withColumn("t_p_raw", student_t_two_sided("t_stat", "t_df")).drop("_sa", "_sb")


def mann_whitney(summary: DataFrame, exact: bool = True,
                 exact_up_to: int = EXACT_UP_TO) -> DataFrame:
    """Add ``mwu_stat`` (U of group a), ``mwu_p_raw`` (two-sided) and ``rank_biserial``.

    The p-value is the tie- and continuity-corrected normal tail, or with ``exact`` the exact
    distribution where a group has at most ``exact_up_to`` rows and there are no ties.
    """
    shaped = summary.selectExpr(
        "*", "IF(n_a > 0 AND n_b > 0, CAST(n_a AS DOUBLE) * n_b, NULL) AS _pairs",
        "CAST(n_a AS DOUBLE) + n_b AS _n",
    ).selectExpr(
        "*", "IF(_pairs IS NULL, NULL, u_doubled / 2D) AS mwu_stat",
        "sqrt(_pairs / 12D * greatest(0D, _n + 1D - try_divide(tie_sum, _n * (_n - 1D)))) "
        "AS _deviation",
    ).selectExpr("*", "greatest(mwu_stat, _pairs - mwu_stat) AS _larger")
    # Without spread everything is tied: nothing speaks against equality.
    p = F.when(F.expr("_deviation > 0"), F.least(F.lit(1.0), F.lit(2.0) * normal_sf(
        "(_larger - _pairs / 2D - 0.5D) / nullif(_deviation, 0D)"))
    ).when(F.col("_pairs").isNotNull(), F.lit(1.0))
    if exact:
        small = f"_pairs IS NOT NULL AND least(n_a, n_b) <= {exact_up_to} AND largest_tie <= 1"
        tail = exact_rank_sum_p(F.expr(f"IF({small}, _pairs - _larger, NULL)"), F.col("n_a"),
                                F.col("n_b"))
        p = F.coalesce(tail, p)
    return (shaped.withColumn("mwu_p_raw", p)
            .withColumn("rank_biserial", F.expr("2D * mwu_stat / _pairs - 1D"))
            .drop("_pairs", "_n", "_deviation", "_larger"))


def compare_ranked(ranks: DataFrame, keys: list[str], exact: bool = True) -> DataFrame:
    """All statistics of the named rows ``a`` and ``b`` of a ranked histogram, once per ``keys``."""
    return mann_whitney(welch_t(group_summary(ranks, keys, "_value")), exact).selectExpr(
        "*", "mean_a - mean_b AS mean_difference", "median_a - median_b AS median_difference")


def two_group_compare(df: DataFrame, keys: list[str], group: str, value: str, a, b, *,
                      exact: bool = True, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Compare ``value`` between the rows with ``group`` = a and = b, once per ``keys``.

    One row per key with at least one row in either group; statistics that need both groups are
    NULL where one is empty.
    """
    rows = df.where(F.col(group).isin(a, b)).select(
        *keys, F.col(value).cast("double").alias("_value"), (F.col(group) == a).alias("_is_a"))
    ranks = ranked_histogram(rows, keys, "_value", {"a": "_is_a", "b": "NOT _is_a"},
                             rows_per_range=rows_per_range)
    return compare_ranked(ranks, keys, exact)


def tag_scopes(df: DataFrame, timepoints: tuple[int, ...]) -> DataFrame:
    """One row per scope a row belongs to: ``pooled`` always, ``t=<time>`` for listed times."""
    return df.withColumn("scope", F.explode(scopes_of_row(timepoints)))


def scope_ranks(df: DataFrame, study: Study, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The ranked histogram by scope and component of cohort rows (population, percentage,
    response, time); ``a`` is the first response group. Statistics and box plots are read off it.

    One pass groups the rows by time; the pooled scope is the sum of those, so no row is doubled.
    """
    a, b = study.groups
    rows = df.where(F.col("population").isin(list(study.components))
                    & F.col("response").isin(a, b)).select(
        F.coalesce(F.concat(F.lit("t="), F.col(TIME)), F.lit("")).alias("scope"), "population",
        F.col("percentage").cast("double").alias("_value"), (F.col("response") == a).alias("_is_a"))
    timed = histogram(rows, SCOPE_KEYS, "_value", {"a": "_is_a", "b": "NOT _is_a"})
    pooled = timed.groupBy("population", "_value").agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    listed = [f"t={time}" for time in study.timepoints]
    scoped = timed.where(F.col("scope").isin(listed)).unionByName(
        pooled.withColumn("scope", F.lit("pooled")))
    return ranked(staged(scoped, "scopes"), SCOPE_KEYS, "_value", rows_per_range)


def compare_scopes(df: DataFrame, study: Study, *, exact: bool = True,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Group comparison of every component in every scope of cohort rows: ``scope_statistics``."""
    return scope_statistics(scope_ranks(df, study, rows_per_range), study, exact)


def scope_statistics(ranks: DataFrame, study: Study, exact: bool = True) -> DataFrame:
    """Statistics of ``scope_ranks``, adjusted within each scope.

    Result: ``scope`` (pooled, baseline, t=..), ``timepoint`` (NULL for pooled and baseline) and the
    statistics columns. The baseline scope is the first time point under its own name.
    """
    compared = compare_ranked(ranks, SCOPE_KEYS, exact)
    named = compared.selectExpr(
        "scope", "population", "n_a AS n_responder", "n_b AS n_nonresponder",
        "median_a AS median_responder", "median_b AS median_nonresponder",
        "mean_a AS mean_responder", "mean_b AS mean_nonresponder",
        "mean_difference", "median_difference", "rank_biserial", "t_stat", "t_p_raw",
        "mwu_stat", "mwu_p_raw")
    adjusted = significance_flags(
        bh_adjust(named, ["scope"], {"t_p_raw": "t_p_bh", "mwu_p_raw": "mwu_p_bh"}), study.alpha)
    shown = F.explode(F.expr(
        f"IF(scope = 't={study.baseline}', array('baseline', scope), array(scope))"))
    timepoint = F.expr("IF(startswith(scope, 't='), CAST(substring(scope, 3) AS INT), NULL)")
    return (adjusted.withColumn("scope", shown).withColumn("timepoint", timepoint)
            .select("scope", "timepoint", *STATS_COLUMNS))


def stats_order(study: Study) -> list[Column]:
    """Scopes as listed, then components in semantic order."""
    scopes = ["pooled", "baseline", *[f"t={time}" for time in study.timepoints]]
    return [component_rank(F.col("scope"), scopes),
            component_rank(F.col("population"), study.components).asc_nulls_last()]


def one_scope(stats: DataFrame, scope: str, study: Study) -> DataFrame:
    """The statistics table of one scope: 18 columns, rows in component order."""
    return stats.where(F.col("scope") == scope).orderBy(*stats_order(study)).select(*STATS_COLUMNS)


def per_timepoint(stats: DataFrame, study: Study) -> DataFrame:
    """The time-point scopes in one table, the time point first."""
    return (stats.where(F.col("timepoint").isNotNull())
            .orderBy("timepoint", component_rank(F.col("population"), study.components))
            .select("timepoint", *STATS_COLUMNS))
