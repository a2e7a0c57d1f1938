"""Helpers that several operators share: staged tables, text batches, span digests."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyfold.sources.tables import staged  # noqa: F401  the operators' intermediate tables


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` does, once for an application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="tallyfold-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # Spark serves it to every executor
        _shipped.add(context.applicationId)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends, not when the driver's garbage
    collection comes to it: a job of many staged tables keeps those of one at a time."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def text_or_empty(column: str | Column) -> Column:
    """The text as a string; null counts as the empty text."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"),
                      F.lit(""))


def slices(texts: pa.Array, max_bytes: int) -> Iterator[list[str]]:
    """The texts in order, in lists of at most ``max_bytes`` UTF-8 bytes or of one longer text."""
    sizes = pc.binary_length(texts).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > max_bytes:
            yield texts.slice(start, i - start).to_pylist()
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield texts.slice(start).to_pylist()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(rows: int, small: int, most: int, largest: int) -> int:
    """Into how many parts to deal ``rows``: of about ``small`` rows, but at most ``most`` parts
    while none of them is beyond ``largest`` rows."""
    return max(1, min(most, -(-rows // small)), -(-rows // largest))


def best_of(df: DataFrame, keys: list[str], order: list[Column], k: int,
            spread: int = 64) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their ``rank``.

    Rows are ranked within the parts of a key first, so that no task sorts all rows of a key.
    """
    part = fresh(df, "part")
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    for within in ([*keys, part], keys):
        window = Window.partitionBy(*within).orderBy(*order)
        dealt = dealt.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return dealt.drop(part)
