"""Run registered queries and their SQL on the same tables and compare the rows.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.queries import ORACLES, QUERIES


def local_session(cores: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName("verification")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC").getOrCreate())


def connect(sf_dir: str):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    return value


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> tuple[str, float, float]:
    """('' or the first difference, Spark seconds, DuckDB seconds)."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    mine = [tuple(row) for row in df.collect()]
    middle = time.time()
    if name not in ORACLES:
        return f"no SQL, {len(mine)} rows", middle - start, 0.0
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    end = time.time()
    times = middle - start, end - middle
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} against {names}", *times
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}", *times
    order = [names.index(c) for c in df.columns]
    left = Counter(tuple(_cell(v) for v in row) for row in mine)
    right = Counter(tuple(_cell(row[i]) for i in order) for row in theirs)
    if left != right:
        gone, new = list((right - left).items())[:2], list((left - right).items())[:2]
        return f"{sum((left - right).values())} rows differ: {new} against {gone}", *times
    kinds = {type(v) for row in left for v in row}, {type(v) for row in right for v in row}
    return ("" if kinds[0] == kinds[1] else f"types {kinds}"), *times


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        try:
            problem, mine, theirs = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem, mine, theirs = f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0.0
        bad += bool(problem) and not problem.startswith("no SQL")
        print(f"{name:32s} {mine:7.2f}s {theirs:7.2f}s  {problem or 'same'}", flush=True)
    print(f"{len(chosen)} queries, {bad} different")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
