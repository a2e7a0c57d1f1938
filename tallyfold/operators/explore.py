"""Overview counts, vocabularies and the filtered view of the frequency table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.functions.scalars import contains_text, display_round
from tallyfold.study import Study


def table_counts(tables: dict[str, DataFrame], study: Study) -> DataFrame:
    """(metric, value, n): rows of the three entity tables and the number of components."""
    spark = tables["samples"].sparkSession
    out = None
    for name in ("samples", "subjects", "projects"):
        part = tables[name].agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"n_{name}").alias("metric"), F.lit(None).cast("string").alias("value"), "n")
        out = part if out is None else out.unionByName(part)
    listed = spark.range(1).select(
        F.lit("n_populations").alias("metric"), F.lit(None).cast("string").alias("value"),
        F.lit(len(study.components)).cast("bigint").alias("n"))
    return out.unionByName(listed)


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order, NULL first where there is one."""
    return df.select(column).distinct().orderBy(column)


def vocabulary_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, value, n): rows per value of each column, all columns in one pass."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p")
    return (df.select(pairs).select("p.*").groupBy("metric", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def overview(tables: dict[str, DataFrame], study: Study) -> DataFrame:
    """Table counts, then the condition, treatment and sample-type vocabularies."""
    return (table_counts(tables, study)
            .unionByName(vocabulary_counts(tables["subjects"], ["condition", "treatment"]))
            .unionByName(vocabulary_counts(tables["samples"], ["sample_type"])))


def explore(frequencies: DataFrame, components: list[str], contains: str = "", *,
            regex: bool = False, rounded: bool = True) -> DataFrame:
    """Rows of the chosen components whose sample matches; percentages rounded for display.

    No component chosen gives no rows; a blank text filters nothing. Export ``rounded=False``.
    """
    out = frequencies.where(F.col("population").isin(list(components)))
    if contains:
        out = out.where(contains_text(F.col("sample").cast("string"), contains, regex))
    if rounded:
        out = out.withColumn("percentage", display_round(F.col("percentage")))
    return out


def total_range(frequencies: DataFrame) -> DataFrame:
    return frequencies.agg(F.min("total_count").alias("min_total"),
                           F.max("total_count").alias("max_total"),
                           F.count(F.lit(1)).alias("n_rows"))
