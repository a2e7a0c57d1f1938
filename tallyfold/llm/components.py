"""Connected components by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import staged


def _least(links: DataFrame) -> DataFrame:
    """(u, least): the smallest neighbour; combined before the shuffle, so hubs don't matter."""
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node (u > v) and its smaller neighbours are linked to the smallest of those."""
    near = links.join(_least(links), "u")
    return (near.select("u", F.col("least").alias("v"))
            .unionAll(near.where("v > least").select(F.col("v").alias("u"),
                                                     F.col("least").alias("v"))).distinct())


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (u, v) but the roots, the least of each component.

    Self-links, repeats and nulls are left out. Each round is written to the shared folder; rounds
    end when a round changes nothing, after a number logarithmic in the largest component.
    """
    now = staged(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "round")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        now = staged(_small_star(_large_star(now)), "round")
