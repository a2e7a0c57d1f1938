"""Shared rows of the tests: awkward texts, and documents with clashing extra columns."""

from __future__ import annotations

LONG = "lorem ipsum dolor 42 " * 3000
AWKWARD = [None, "", " ", "\t\n", "a", "Ünïcödé ✓ 😀 日本語", LONG, "x" * 20000, "7" * 9000,
           "same text twice", "same text twice", "\\ \x00 \x0b  "]
#: Names that operators use for columns of their own.
CLASHES = "fingerprint long, score double, row_number int, verdict string, codec int, found int"


def documents(spark, texts, first=0):
    """doc_id, text and clashing columns; the last id is null, the first one repeated."""
    rows = [(first + i, t, i, float(i), i, "x", i, i) for i, t in enumerate(texts)]
    rows += [(None, "no id", 0, 0.0, 0, "x", 0, 0), (first, "id again", 0, 0.0, 0, "x", 0, 0)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}")


def no_documents(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHES}")


def texts(sf_dir="/root/testdata/sf0.001"):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall()
