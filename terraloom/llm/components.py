"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import salted_join, written


def _large_star(e: DataFrame, total: int) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")).select("a", F.least("a", "low").alias("low"), "n")
    return salted_join(both, low, "a", "n", 2 * total, "b", "inner").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(e: DataFrame, total: int) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
    moved = salted_join(e, low, "a", "n", total, "b", "inner").filter(F.col("b") > F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) of every node that isn't its own root.

    ``links``: longs a > b, each pair once. Each round points every node at the smallest of its
    neighbours, first from larger to smaller and then among the smaller ones; it ends when a
    round changes nothing, after about the logarithm of the longest chain. The links of a node
    with very many are dealt over several tasks. Rounds are written to the shared folder, and
    only a count and a checksum come to the driver. No links: no rows.
    """
    e, was = written(links.select("a", "b"), "links"), None
    for _ in range(most_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == was or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        large = written(_large_star(e, now[0]), "large-star")
        e, was = written(_small_star(large, now[0]), "links"), now
    raise RuntimeError(f"links still change after {most_rounds} rounds")
