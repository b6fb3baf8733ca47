"""Connected components of a graph given as edges, by alternating large-star and small-star rounds.

Everything stays distributed; each round is written to the shared folder, which also ends lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import forget, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _to_least(near: DataFrame, keep: str) -> DataFrame:
    """(v, least neighbour of u or u itself) for the neighbours v of u that keep selects, and for u itself."""
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).select(F.col("u").alias("_u"), "m")
    pairs = near.where(keep).join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pairs.unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def _settled(state: DataFrame) -> bool:
    """Whether edges (u, v), v < u, are stars: each u has one edge, and no node is at both ends."""
    ends = state.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(state.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of an edge (columns u, v; longs).

    Loops and repeated edges don't matter; a graph without edges gives no rows. Rounds go on until all
    components are stars around their smallest node; their number grows with the logarithm of the graph.
    """
    state = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not _settled(state):
        large = _to_least(_both(state), "v > u")
        small = _to_least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "v < u")
        before, state = state, stored(small, "edges")  # distinct, and v < u
        forget(before)
    root = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = stored(root.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "roots")
    forget(state)
    return out
