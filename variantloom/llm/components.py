"""Connected components of a graph given as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stash


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of links (a, b) of longs; root is the component's smallest node. Links are never collected: a round writes its table, and only its count and checksum come to the driver."""
    now = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = new
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted_join(both.where("v > u"), lows, "u", "v", how="inner").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(now).where("u > v").distinct()
        # the links kept beside the large star make it monotone; the small star then hangs each node on its least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = salted_join(large, least, "u", "v", how="inner")
        now = stash(hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "links")
    raise RuntimeError("components did not settle")
