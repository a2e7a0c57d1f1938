"""The study roles mapped onto the star tables.

A sample is an order, its subject the customer, its project the customer's nation, its component
counts the quantities per (return flag, line status) of its line items.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.operators.cohort import comparison_cohort, select_cohort
from tallyfold.operators.composition import composition_of_wide
from tallyfold.operators.skew import lookup_join
from tallyfold.study import METADATA, TIME, Study

STAR = Study(
    components=("N_O", "A_F", "R_F", "N_F", "A_O", "R_O"),
    cohort={"condition": "BUILDING", "treatment": "miraclib", "sample_type": "PBMC"},
    labels={"N_O": "New open", "A_F": "Accepted final", "R_F": "Returned final"},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey",
                                                       "n_name AS project")
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").selectExpr(
        "c_custkey", "CAST(c_custkey AS STRING) AS subject", "project",
        "c_mktsegment AS condition", "CAST(c_custkey % 50 + 20 AS INT) AS age",
        "IF(c_custkey % 2 = 0, 'F', 'M') AS sex",
        """CASE WHEN c_mktsegment = 'FURNITURE' THEN 'none'
                WHEN c_custkey % 3 = 0 THEN 'phauximab' ELSE 'miraclib' END AS treatment""",
        """CASE WHEN c_mktsegment = 'FURNITURE' OR c_custkey % 7 = 0 THEN NULL
                WHEN c_acctbal >= 4500 THEN 'yes' ELSE 'no' END AS response""")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey AS c_custkey", "CAST(o_orderkey AS STRING) AS sample",
        "IF(o_orderstatus = 'F', 'WB', 'PBMC') AS sample_type",
        f"CAST(o_orderkey % 3 * 7 AS INT) AS {TIME}")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with line items: one summed quantity column per component."""
    sums = []
    for name in STAR.components:
        flag, status = name.split("_")
        mine = f"l_returnflag = '{flag}' AND l_linestatus = '{status}'"
        sums.append(F.expr(f"CAST(sum(IF({mine}, l_quantity, 0D)) AS BIGINT)").alias(name))
    return (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(*sums))


def _filled() -> list[str]:
    return [f"coalesce({c}, 0L) AS {c}" for c in STAR.components]


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample metadata and the order key."""
    joined = lookup_join(samples(spark, sf_dir), subjects(spark, sf_dir), "c_custkey")
    return joined.select("o_orderkey", *METADATA)


def _with_counts(meta: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = meta.join(counts(spark, sf_dir), "o_orderkey", "left")
    return joined.selectExpr(*METADATA, *_filled())


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_counts(metadata(spark, sf_dir), spark, sf_dir)


def filled_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples the loader accepts: a total above zero."""
    return wide(spark, sf_dir).where(" + ".join(STAR.components) + " > 0")


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency rows of the comparison cohort. The cohort is chosen on the metadata, before the
    counts join; totals are taken along the row, before the unpivot."""
    chosen = _with_counts(comparison_cohort(metadata(spark, sf_dir), STAR), spark, sf_dir)
    return composition_of_wide(chosen, STAR.components, keep=METADATA[1:])


# A second study over the same samples with findings at every scale: a sample responds where more than
# a third of its quantity lies in one component.
SHIFTED = replace(STAR, cohort={"condition": "BUILDING", "treatment": "miraclib"})
LEADING = STAR.components[0]


def _shifted_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_cohort(metadata(spark, sf_dir), SHIFTED.cohort)
    total = " + ".join(STAR.components)
    return _with_counts(chosen, spark, sf_dir).withColumn(
        "response", F.expr(f"IF(3 * {LEADING} > {total}, 'yes', 'no')"))


def shifted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second study's cohort metadata: the counts decide the response."""
    return _shifted_wide(spark, sf_dir).select(*METADATA)


def shifted_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composition_of_wide(_shifted_wide(spark, sf_dir), STAR.components, keep=METADATA[1:])


def malformed_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The faulty text with a surplus field in some lines and the last field missing in others."""
    text = faulty_text(spark, sf_dir, "l_partkey % 97 AS mark").withColumn(
        "last", F.expr("CASE mark WHEN 0 THEN concat(tax_percent, ',more') "
                       "WHEN 1 THEN NULL ELSE tax_percent END"))
    fields = [F.coalesce(F.col(c), F.lit("")) for c in LINES.wide_columns[:-1]]
    line = F.concat_ws(",", *fields, "last").alias(",".join(LINES.wide_columns))
    # one column under the header's text; its separator occurs in no line, so nothing is quoted
    text.select(line).write.option("header", True).option("sep", "\x01").csv(path)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four normalised tables, straight from the star tables."""
    taken = samples(spark, sf_dir)
    counted = taken.join(counts(spark, sf_dir), "o_orderkey", "left").selectExpr(
        "sample AS sample_id", *_filled())
    return {
        "projects": table(spark, sf_dir, "nation").selectExpr("n_name AS project_id"),
        "subjects": subjects(spark, sf_dir).selectExpr(
            "subject AS subject_id", "project AS project_id", "condition", "age", "sex",
            "treatment", "response"),
        "samples": taken.selectExpr("sample AS sample_id",
                                    "CAST(c_custkey AS STRING) AS subject_id", "sample_type",
                                    TIME),
        "cell_counts": counted.unpivot("sample_id", list(STAR.components), "population", "count"),
    }


# Line items as a wide input in text form that breaks every rule: repeated line numbers,
# negative gaps, zero totals, orders with several flags and an age that is no number.
LINES = Study(components=("price_gap", "tax_percent"), cohort={})


def faulty_text(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    columns = {
        "project": "l_linestatus", "subject": "l_orderkey", "condition": "l_returnflag",
        "age": "CASE l_quantity WHEN 50 THEN 'n/a' WHEN 49 THEN 'unknown' "
               "ELSE CAST(l_quantity AS STRING) END",
        "sex": "IF(l_suppkey % 2 = 0, 'F', 'M')", "treatment": "'none'",
        "response": "CASE l_partkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE '' END",
        "sample": "concat_ws('-', l_orderkey, l_linenumber)", "sample_type": "'PBMC'",
        TIME: "l_linenumber",
        "price_gap": "CAST(round(l_extendedprice * (l_discount - 0.05D), 0) AS BIGINT)",
        "tax_percent": "CAST(round(l_tax * 100, 0) AS BIGINT)",
    }
    return table(spark, sf_dir, "lineitem").selectExpr(
        *[f"CAST({expression} AS STRING) AS {name}" for name, expression in columns.items()], *more)
