"""Cohort selection, subject-level deduplication and breakdowns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.study import COHORT_COLUMNS, TIME, Study


def cohort_predicate(equals: Mapping[str, object]) -> Column:
    predicate = F.lit(True)
    for column, wanted in equals.items():
        predicate = predicate & (F.col(column) == F.lit(wanted))
    return predicate


def select_cohort(df: DataFrame, equals: Mapping[str, object],
                  known_group: tuple[str, Iterable[str]] | None = None) -> DataFrame:
    """Rows matching every column value; ``known_group`` also requires a listed group value."""
    out = df.where(cohort_predicate(equals))
    if known_group is not None:
        column, groups = known_group
        out = out.where(F.col(column).isin(list(groups)))
    return out


def comparison_cohort(df: DataFrame, study: Study) -> DataFrame:
    """The study's cohort with a known response."""
    return select_cohort(df, study.cohort, ("response", study.groups))


def baseline_cohort(metadata: DataFrame, study: Study) -> DataFrame:
    """The study's cohort at baseline, response known or not."""
    chosen = select_cohort(metadata, {**study.cohort, TIME: study.baseline})
    return chosen.select(*COHORT_COLUMNS)


def first_per(df: DataFrame, owner: str, order: list[str]) -> DataFrame:
    """One row per owner, the first in the given order.

    An aggregate rather than a window: partial results are combined before the shuffle, so an
    owner with very many rows costs no task more than its share.
    """
    others = [c for c in df.columns if c != owner]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return df.groupBy(owner).agg(first.alias("_first")).select(owner, "_first.*")


def breakdown(df: DataFrame, key: str, *, one_per: str | None = None, order: str = "sample",
              name: str | None = None) -> DataFrame:
    """Rows per key, or with ``one_per`` owners per key counted by their first row.

    NULL keys are not counted; an empty input keeps the two columns; rows are ordered by key.
    """
    counted = df
    if one_per is not None:
        # An owner counts under the key of its first row; dropped if that key is NULL.
        counted = df.groupBy(one_per).agg(
            F.min_by(F.struct(F.col(key).alias("key")), F.col(order)).alias("_first")
        ).select(F.col("_first.key").alias(key))
    label = name or ("n_subjects" if one_per else "n_samples")
    return (counted.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(label)).orderBy(key))


def subject_total(by_response: DataFrame, column: str = "n_subjects") -> DataFrame:
    return by_response.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total_subjects"))


def scopes_of_row(timepoints: Iterable[int]) -> Column:
    """The scopes a row belongs to: ``pooled``, and ``t=<time>`` for a listed time."""
    listed = ", ".join(str(int(time)) for time in timepoints)
    own = f"IF({TIME} IN ({listed}), concat('t=', {TIME}), NULL)" if listed else "NULL"
    return F.expr(f"array_compact(array('pooled', {own}))")


def cohort_profile(df: DataFrame, study: Study) -> DataFrame:
    """Per scope (pooled and each time point): samples, subjects, subjects per response, from
    one row per sample.

    Subjects are grouped before they are counted, so no task holds a whole scope.
    """
    tagged = df.select("sample", "subject", "response",
                       F.explode(scopes_of_row(study.timepoints)).alias("scope"))
    subjects = tagged.groupBy("scope", "subject").agg(
        F.min_by(F.struct("response"), F.col("sample")).alias("_first"),
        F.count(F.lit(1)).alias("n"))
    a, b = study.groups
    return subjects.groupBy("scope").agg(
        F.sum("n").alias("n_samples"), F.count(F.lit(1)).alias("n_subjects"),
        F.count_if(F.col("_first.response") == a).alias("n_responder_subjects"),
        F.count_if(F.col("_first.response") == b).alias("n_nonresponder_subjects"))
