"""The wide CSV: one row per sample, metadata and one count column per component."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyfold.sources.quoted_lines import InvalidInput, ends_outside, quoted_records
from tallyfold.sources.tables import laid_out, scope, working_dir
from tallyfold.study import TIME, Study

# Texts that mean "no value" in the input. Lower-case "none" is a treatment.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
UNCASTABLE = "_uncastable"
MALFORMED = "_malformed"


def column_differences(columns: list[str], study: Study) -> tuple[list[str], list[str]]:
    """(missing, unexpected) column names, each sorted."""
    expected = set(study.wide_columns)
    return sorted(expected - set(columns)), sorted(set(columns) - expected)


def require_columns(columns: list[str], study: Study) -> None:
    missing, unexpected = column_differences(columns, study)
    parts = [f"{kind} columns: {names}"
             for kind, names in (("missing", missing), ("unexpected", unexpected)) if names]
    if parts:
        raise InvalidInput("load_data: " + "; ".join(parts))


def _first_line(spark: SparkSession, path: str) -> str:
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV not found: {path}") from error
        raise
    return "" if row is None else row[0].removeprefix("\ufeff")


def header_columns(header: str) -> list[str]:
    columns = next(csv.reader([header]), [])
    if len(set(columns)) < len(columns):
        raise InvalidInput(f"load_data: repeated columns: {sorted(columns)}")
    return columns


def parsed(records: DataFrame, columns: list[str]) -> DataFrame:
    """Every column as text, and ``_malformed``: the text of a record with more or fewer fields than
    the header, else NULL. ``records`` has one column, a record's text with its line breaks."""
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, MALFORMED])
    fields = F.from_csv(F.col(records.columns[0]), schema, {
        "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED})
    return records.select(fields.alias("fields")).select("fields.*")


def write_wide(spark: SparkSession, path: str, study: Study, folder: str) -> DataFrame:
    """The wide input under its explicit types, written to ``folder`` and read back.

    Columns are bound by the header, which must be the same line in all files. The text is read once,
    line by line in parallel; while the rows are written it is counted which lines end inside a
    quoted field. Only if there are any, it is read again by blocks (``quoted_records``). Rows of one
    cohort lie together in a file, so that a cohort's read leaves the others out.
    """
    header = _first_line(spark, path)
    columns = header_columns(header)
    require_columns(columns, study)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path").count()
    seen = Observation()
    lines = spark.read.text(path).select(F.when(
        F.startswith("value", F.lit("\ufeff")), F.substr("value", F.lit(2))).otherwise(
            F.col("value")).alias("value"))
    watched = lines.observe(seen, F.count_if(F.col("value") == header).alias("headers"),
                            F.count_if(~ends_outside(F.col("value"))).alias("open"))
    records = watched.where((F.col("value") != header) & (F.trim("value") != ""))
    typed = type_wide(parsed(records, columns), study)
    order = *study.cohort, TIME, "response"
    laid_out(typed, order).parquet(folder)
    if seen.get["open"]:
        with scope(spark):
            records = quoted_records(spark, path, header)
            laid_out(type_wide(parsed(records, columns), study), order).parquet(folder)
    elif seen.get["headers"] != files:
        raise InvalidInput(f"load_data: {seen.get['headers']} header lines in {files} files; each must "
                           f"start with the same header: {header}")
    return spark.read.schema(typed.schema).parquet(folder)


def read_wide(spark: SparkSession, path: str, study: Study) -> DataFrame:
    """The wide input under its explicit types; refuses a wrong column set. See ``write_wide``."""
    return write_wide(spark, path, study, f"{working_dir(spark)}/wide")


def blank_to_null(column: str) -> str:
    """SQL of a text column with the "no value" texts turned into NULL."""
    texts = ", ".join(f"'{text}'" for text in NA_TEXTS)
    return f"IF(`{column}` IN ({texts}), NULL, `{column}`)"


def whole_number(text: str, kind: str = "BIGINT") -> str:
    """SQL of a whole number (``5``, ``5.0`` or ``5e0``); NULL for anything else.

    The patterns come first because a failing cast costs some twenty times a matching one.
    """
    number = f"CAST(trim({text}) AS DOUBLE)"
    return (
        f"CASE WHEN trim({text}) RLIKE '^[+-]?[0-9]+$' THEN try_cast(trim({text}) AS {kind}) "
        f"WHEN trim({text}) RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' "
        f"THEN IF({number} = floor({number}), try_cast({number} AS {kind}), NULL) END")


def type_wide(raw: DataFrame, study: Study) -> DataFrame:
    """Blank to NULL, integers cast; ``_uncastable`` lists the integer columns without a value."""
    kinds = {**dict.fromkeys(study.components, "BIGINT"), "age": "INT", TIME: "INT"}
    extra = [MALFORMED] if MALFORMED in raw.columns else []
    texts = raw.selectExpr(*[f"{blank_to_null(name)} AS `{name}`" for name in study.wide_columns],
                           *extra)
    typed = texts.selectExpr(*[
        f"{whole_number(f'`{name}`', kinds[name])} AS `{name}`" if name in kinds else f"`{name}`"
        for name in study.wide_columns], *extra)
    failed = ", ".join(f"IF(`{name}` IS NULL, '{name}', NULL)" for name in kinds)
    return typed.selectExpr("*", f"array_compact(array({failed})) AS {UNCASTABLE}")
