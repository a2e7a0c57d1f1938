"""Relative frequencies of components within an entity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.functions.scalars import relative_frequency

FREQUENCY_COLUMNS = ("sample", "total_count", "population", "count", "percentage")


def composition(df: DataFrame, entity: str = "sample", component: str = "population",
                value: str = "count", *, keep: Iterable[str] = (),
                one_row_per_component: bool = False) -> DataFrame:
    """Total per entity and each component's percentage, from one row per (entity, component).

    Totals are summed map-side and joined back, so an entity (or NULL) with very many rows is split
    by adaptive execution like any heavy join key. A caller whose entities have one row for each of
    a listed few components says so (``one_row_per_component``): a window then needs one shuffle.
    """
    shape = [entity, "total_count", component, value, "percentage", *keep]
    if one_row_per_component:
        out = df.withColumn("total_count", F.sum(value).over(Window.partitionBy(entity)))
    else:
        totals = df.groupBy(F.col(entity).alias("_entity")).agg(F.sum(value).alias("total_count"))
        out = df.join(totals, F.col(entity).eqNullSafe(F.col("_entity")))
    percentage = relative_frequency(F.col(value), F.col("total_count"))
    return out.withColumn("percentage", percentage).select(*shape)


def composition_of_wide(df: DataFrame, components: Iterable[str], entity: str = "sample",
                        keep: Iterable[str] = ()) -> DataFrame:
    """The same from one wide row per entity: total along the row, then unpivot. No shuffle."""
    components = list(components)
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in components[1:]),
                F.coalesce(F.col(components[0]), F.lit(0)))
    ids = [entity, *keep, "total_count"]
    long = (df.withColumn("total_count", total.cast("bigint"))
            .select(*ids, *components)
            .unpivot(ids, components, "population", "count"))
    return long.withColumn(
        "percentage", relative_frequency(F.col("count"), F.col("total_count"))
    ).select(entity, "total_count", "population", "count", "percentage", *keep)


def composition_of_events(df: DataFrame, entity: str, component: str) -> DataFrame:
    """Composition of raw event rows: count per (entity, component) first."""
    counted = df.groupBy(entity, component).agg(F.count(F.lit(1)).alias("count"))
    return composition(counted, entity, component, "count")
