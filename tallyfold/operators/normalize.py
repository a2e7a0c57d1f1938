"""From the wide input to project, subject, sample and count tables, and back to metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.operators.cohort import first_per
from tallyfold.operators.skew import lookup_join
from tallyfold.study import METADATA, TABLES, TIME, Study


def projects(df: DataFrame) -> DataFrame:
    return df.select(F.col("project").alias("project_id")).distinct()


def subjects(df: DataFrame) -> DataFrame:
    """One row per subject, its attributes taken from its first sample by time, then id."""
    attributes = ["project", "condition", "age", "sex", "treatment", "response"]
    first = first_per(df.select("subject", *attributes, TIME, "sample"), "subject",
                      [TIME, "sample"])
    return first.select(F.col("subject").alias("subject_id"),
                        F.col("project").alias("project_id"),
                        "condition", "age", "sex", "treatment", "response")


def samples(df: DataFrame) -> DataFrame:
    return df.select(F.col("sample").alias("sample_id"), F.col("subject").alias("subject_id"),
                     "sample_type", TIME)


def cell_counts(df: DataFrame, study: Study) -> DataFrame:
    """Long counts: one row per sample and component, zeros and NULLs kept."""
    return df.select(F.col("sample").alias("sample_id"), *study.components).unpivot(
        "sample_id", list(study.components), "population", "count")


def normalize(df: DataFrame, study: Study) -> dict[str, DataFrame]:
    made = {"projects": projects(df), "subjects": subjects(df), "samples": samples(df),
            "cell_counts": cell_counts(df, study)}
    return {name: made[name].select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                      for f in schema])
            for name, schema in TABLES.items()}


def sample_metadata(tables: dict[str, DataFrame], *, keys_checked: bool = False) -> DataFrame:
    """One row per sample with its subject's and project's attributes.

    ``keys_checked``: every subject's project is known to exist (tables made by ``normalize``),
    so the join with projects, which adds no column, is left out.
    """
    people = tables["subjects"]
    if not keys_checked:
        people = lookup_join(people, tables["projects"].select("project_id"), "project_id")
    joined = lookup_join(tables["samples"], people, "subject_id")
    return joined.select(
        F.col("sample_id").alias("sample"), F.col("subject_id").alias("subject"),
        F.col("project_id").alias("project"), *METADATA[3:])


def with_metadata(frequencies: DataFrame, metadata: DataFrame) -> DataFrame:
    """Frequency rows with their sample's metadata: 14 columns.

    A sample has at most one frequency row per component, so its key cannot grow heavy.
    """
    return frequencies.join(metadata, "sample")
