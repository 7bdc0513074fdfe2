"""Connected components of links between 64-bit keys, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.session import written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links`` (long columns ``a`` and ``b``); root is the smallest node reachable.

    Each round links every node to its smallest neighbour, first for larger neighbours, then for smaller ones; the number of
    rounds grows with the logarithm of a component's size. Links stay distributed; only two sums per round reach the
    driver. Each round is written to the shared folder, which cuts lineage. No links give no rows.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
