"""Connected components by repeated star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cauce.sources.scratch import materialise


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of ``links`` (``a``, ``b``: long, never NULL).

    ``component`` is the smallest node that can be reached. Large-star and small-star steps
    alternate until the links no longer change; each step is one aggregate and one join, and its
    links are written to the shared folder, so a lost executor costs one step. Only counts come
    to the driver. A node with very many links is pre-aggregated for its minimum, and the join
    that follows splits it. Equal links, loops and an empty table are fine.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = materialise(links.filter("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "links")
    before = None
    while True:
        now = materialise(_small_star(_large_star(now)), "links")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return (
        both.filter("b > a").join(least, F.col("a") == F.col("n"))
        .filter("m < b").select(F.col("m").alias("a"), "b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("n"), "m")
    moved = links.join(least, F.col("b") == F.col("n")).filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("n").alias("b"))).distinct()
