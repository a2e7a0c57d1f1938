"""Joins of many fact rows to the one lookup row of their key, and rows dealt evenly over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: A lookup up to both bounds is broadcast: its rows, and the characters of their values.
BROADCAST_ROWS, BROADCAST_CHARS = 100_000, 16 << 20
#: Counters of the sketch; rows of a key that a task may hold; tasks that heavy keys may fill at most.
BUCKETS, ROWS_PER_TASK, MOST_TASKS = 1 << 14, 1_000_000, 10_000
#: Rows of a task that keeps most of them in memory, such as a partial aggregate by almost unique keys.
ROWS_HELD = 500_000


def parts_of(spark: SparkSession, rows: int, rows_per_task: int | None = None) -> int:
    """Tasks for so many rows: one for each core, more where one would get more than its rows
    (ROWS_HELD, unless given)."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // (rows_per_task or ROWS_HELD)))


def spread(stored: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """The rows of a stored table dealt evenly over tasks by their number.

    A scan's tasks are cut by the bytes of the files: a small file is one task, whatever an expression
    costs a row, and a split of a well compressed one has many millions of rows. Rows are counted first,
    from the files' footers; those of one task stay where they are.
    """
    rows = stored.count()
    return stored if rows <= (rows_per_task or ROWS_HELD) else stored.repartition(
        parts_of(stored.sparkSession, rows, rows_per_task))


def is_small(lookup: DataFrame) -> bool:
    """Whether the lookup is within the bounds of a broadcast; no more rows than that are read."""
    chars = F.sum(F.length(F.concat_ws("", F.array(*[
        F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")) for f in lookup.schema]))))
    rows, size = lookup.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), chars).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_CHARS


def heavy_keys(facts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """(key, parts): the keys with more rows than a task should hold, and over how many parts to deal
    them; None where there is none.

    Rows are counted by bucket of the key's hash, combined before the shuffle. Only keys of buckets
    beyond the limit are then counted one by one, so what comes out is exact. The limit grows with the
    rows, so that there are at most MOST_TASKS such keys.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    counts = {r["bucket"]: r["n"] for r in facts.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most BUCKETS rows
    limit = max(rows_per_task, sum(counts.values()) // MOST_TASKS)
    suspects = [place for place, n in counts.items() if n > limit]
    if not suspects:
        return None
    return (facts.where(bucket.isin(suspects)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > limit)
            .select(key, F.ceil(F.col("n") / limit).cast("int").alias("parts")))


def _salted(facts: DataFrame, lookup: DataFrame, key: str, how: str, heavy: DataFrame) -> DataFrame:
    """Rows of a heavy key are dealt over its parts, its lookup row is copied to each of them.

    A row's part depends on its values and its input partition, so a repeated task deals alike.
    """
    heavy = F.broadcast(heavy.select(key, F.col("parts").alias("_parts")))  # MOST_TASKS rows at most
    values = [F.col(f"`{f.name}`") for f in facts.schema if not isinstance(f.dataType, T.MapType)]
    part = F.pmod(F.xxhash64(*values, F.spark_partition_id()), F.coalesce("_parts", F.lit(1)))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    dealt = facts.join(heavy, key, "left").withColumn("_part", part.cast("int")).drop("_parts")
    copies = lookup.join(heavy, key, "left").withColumn("_part", every).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Join fact rows to the one ``lookup`` row of their key (``how``: inner or left).

    ``lookup`` must be unique on ``key``. A small one is broadcast behind a check of its size; beyond
    that, keys with a large share of the rows are found by ``heavy_keys`` and dealt over several
    tasks, however many such keys there are. NULL keys have no lookup row: an inner join leaves them
    out before its shuffle, a left join keeps them where they are.
    """
    known = facts.where(F.col(key).isNotNull())
    if is_small(lookup):
        joined = known.join(F.broadcast(lookup), key, how)
    elif (heavy := heavy_keys(known.select(key), key, rows_per_task)) is None:
        joined = known.join(lookup, key, how)
    else:
        joined = _salted(known, lookup, key, how, heavy)
    if how == "inner":
        return joined
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != key]
    return joined.unionByName(facts.where(F.col(key).isNull()).select("*", *absent))
