"""Result tables: write, publish, read back, and the folders for intermediate ones."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime, timedelta, timezone
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from tallyfold.study import TABLES, TIME

POINTERS = "published"
#: A run that started longer ago and was never published is taken for a crashed one.
ABANDONED = timedelta(days=7)
_STAMP = "%Y%m%dT%H%M%S%f"


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tallyfold-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``, which lasts.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/tallyfold-{uuid.uuid4().hex}"


class Scope:
    """The intermediate tables of a job, in one folder."""

    def __init__(self, spark: SparkSession, outer: Scope | None):
        self.spark, self.outer, self.made = spark, outer, 0
        self.folder = shared_dir(spark)

    def new_folder(self) -> str:
        self.made += 1
        return f"{self.folder}/{self.made}"

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written outside the scope and read back, so that it outlives the scope's tables; as
        it is if it reads none of them."""
        if not any(self.folder in file for file in df.inputFiles() if self.made):
            return df
        folder = shared_dir(self.spark) if self.outer is None else self.outer.new_folder()
        return _stored(df, f"{folder}/result")


_scope: ContextVar[Scope | None] = ContextVar("tallyfold_scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Delete the tables that ``staged`` writes inside, at the end, whether the job fails or not."""
    current = Scope(spark, _scope.get())
    token = _scope.set(current)
    try:
        yield current
    finally:
        _scope.reset(token)
        if current.made:
            drop_folder(spark, current.folder)


def working_dir(spark: SparkSession) -> str:
    """A new shared folder that is deleted with the running scope; without one it lasts."""
    current = _scope.get()
    return shared_dir(spark) if current is None else current.new_folder()


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as an intermediate table of the running scope, and read back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not those that made it.
    """
    return _stored(df, f"{working_dir(df.sparkSession)}/{name}")


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: str | None = None) -> None:
    """Replace the table at ``path``; CSV gets a header and full-precision numbers."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema=None) -> DataFrame | None:
    """The table at ``path``, or None where there is none."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_run(out_dir: str) -> tuple[str, str]:
    """(run id, run folder); ids sort by time."""
    stamp = datetime.now(timezone.utc).strftime(_STAMP)
    run = f"{stamp}-{uuid.uuid4().hex[:8]}"
    return run, f"{out_dir.rstrip('/')}/run={run}"


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of our own, wherever the cluster's file system keeps it."""
    system, path = _file_system(spark, folder)
    system.delete(path, True)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where there is no folder."""
    system, path = _file_system(spark, folder)
    if not system.exists(path):
        return []
    return sorted(str(f.getPath().getName()) for f in system.listStatus(path))


def _pointer(out_dir: str, number: int) -> str:
    return f"{out_dir.rstrip('/')}/{POINTERS}/{number:010d}"


def _numbers(spark: SparkSession, out_dir: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{out_dir.rstrip('/')}/{POINTERS}") if n.isdigit()]


def _create(spark: SparkSession, name: str, text: str) -> bool:
    """Write a file that mustn't exist yet; False if another job was first."""
    system, path = _file_system(spark, name)
    try:
        out = system.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def publish(spark: SparkSession, out_dir: str, run: str) -> None:
    """Make a finished run the current one: its name goes into the next numbered pointer file.

    A number is created by one job only; a job that comes second takes the number after it.
    """
    number = max(_numbers(spark, out_dir), default=0) + 1
    while not _create(spark, _pointer(out_dir, number), run):
        number += 1


def published_runs(spark: SparkSession, out_dir: str) -> list[tuple[int, str]]:
    """(number, run) of the published runs, the current one last: the pointers alone decide."""
    if not _numbers(spark, out_dir):
        return []
    rows = spark.read.text(f"{out_dir.rstrip('/')}/{POINTERS}").select(
        F.col("_metadata.file_name").alias("name"), "value").collect()  # a row for each kept run
    return sorted((int(r["name"]), r["value"]) for r in rows if r["name"].isdigit())


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """Folder of the current run, None before the first one."""
    runs = published_runs(spark, out_dir)
    return f"{out_dir.rstrip('/')}/run={runs[-1][1]}" if runs else None


def prune_runs(spark: SparkSession, out_dir: str, keep: int,
               abandoned: timedelta = ABANDONED) -> None:
    """Delete all but the last ``keep`` published runs, and runs that were never published and
    started longer than ``abandoned`` ago. A run that is still being written is left alone."""
    root, runs = out_dir.rstrip("/"), published_runs(spark, out_dir)
    kept = {run for _, run in runs[-keep:]}
    for number, run in runs[:-keep]:
        if run not in kept:
            drop_folder(spark, f"{root}/run={run}")
        drop_folder(spark, _pointer(out_dir, number))
    oldest = (datetime.now(timezone.utc) - abandoned).strftime(_STAMP)
    for name in _names(spark, root):
        run = name.removeprefix("run=")
        if name != run and run not in {r for _, r in runs} and run < oldest:
            drop_folder(spark, f"{root}/{name}")


def write_together(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Write independent tables as concurrent Spark jobs, so small ones fill idle executors."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = [pool.submit(write_table, df, f"{folder}/{name}", fmt)
                   for name, df in tables.items()]
        for job in running:
            job.result()


#: How the tables are laid out for selective reads: the order of the rows in a file, by which the
#: statistics of its row groups and pages leave parts out, and the keys with a Bloom filter.
LAYOUT: dict[str, tuple[tuple[str, ...], str]] = {
    "subjects": (("condition", "treatment", "response", "subject_id"), "subject_id"),
    "samples": (("sample_type", TIME, "subject_id"), "sample_id"),
    "cell_counts": (("sample_id",), "sample_id"),
}


def laid_out(df: DataFrame, order: Iterable[str], key: str | None = None) -> DataFrameWriter:
    """A writer of ``df`` that replaces the table, each file in ``order`` and, as Parquet, with a Bloom
    filter on ``key``."""
    writer = df.sortWithinPartitions(*order).write.mode("overwrite")
    return writer if key is None else writer.option(f"parquet.bloom.filter.enabled#{key}", "true")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Write the four tables by their ``LAYOUT``, as concurrent jobs."""
    def write(name: str) -> None:
        if name in LAYOUT:
            laid_out(tables[name], *LAYOUT[name]).parquet(f"{folder}/{name}")
        else:
            write_table(tables[name], f"{folder}/{name}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        for job in [pool.submit(write, name) for name in TABLES]:
            job.result()


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}")
            for name, schema in TABLES.items()}
