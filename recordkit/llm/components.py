"""Connected components of links between keys, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordkit.sources.tables import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("low").alias("a"), "b").filter("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("low"))
    smaller = links.join(least, "b").select(F.col("low").alias("low"), F.col("a").alias("node"))
    own = least.select("low", F.col("b").alias("node"))
    return smaller.unionByName(own).filter("low < node").distinct().select(F.col("low").alias("a"), F.col("node").alias("b"))


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``links`` (columns ``a``, ``b``) but the smallest.

    The nodes' order must be total; self links and null ends are dropped, direction and repeats do not matter. Nodes
    with a third of all links are aggregated before a shuffle and met in inner joins, which adaptive execution splits.
    Each round writes its links to the shared folder, so a lost executor repeats one round at most. No links give no
    rows; more than ``rounds`` rounds raise an error instead of giving a partial result.
    """
    pairs = links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stage(pairs.distinct(), "links")
    before = None
    for _ in range(rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component"))
        before = mark
        now = stage(_small_star(_large_star(now)), "links")
    raise ValueError(f"links did not settle within {rounds} rounds")
