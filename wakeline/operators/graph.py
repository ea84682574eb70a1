"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minimums and joins; edges move to the smallest neighbour, so the
number of rounds grows with the logarithm of the longest chain, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(lows, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lows = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(lows, "u")
    spread = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lows.select("u", F.col("m").alias("v"))
    return spread.unionByName(own).where("u != v").distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the component is the smallest node reachable. ``nodes``: node; ``edges``: u, v.

    Rounds go on until the edges no longer change; every round moves them to smaller nodes, so they end.
    """
    current = cut_lineage(edges.select("u", "v").where("u != v").distinct())
    before = None
    while True:
        current = cut_lineage(_small_star(_large_star(current)))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return nodes.join(current.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
