"""Connected components inside groups by alternating large and small stars (Kiveris et
al., "Connected Components in MapReduce and Beyond"): a logarithmic number of rounds, no
component in one task, state written to the checkpoint folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """``edges(g, u, v)`` plus ``m``: the smallest of u and its neighbours."""
    low = edges.groupBy("g", "u").agg(F.min("v").alias("m")).select(
        F.col("g").alias("_g"), F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return edges.join(low, F.col("g").eqNullSafe(F.col("_g")) & (F.col("u") == F.col("_u"))).select("g", "u", "v", "m")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``g, node, root`` for every row of ``nodes(g, node)``: the smallest node that
    ``edges(g, u, v)`` reach from it, itself included."""
    up = lambda df, a, b: df.select("g", F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    stars, seen = materialize(up(edges, "u", "v")), None
    while True:
        both = stars.union(stars.select("g", F.col("v").alias("u"), F.col("u").alias("v")))
        large = up(_lowest(both).where("v > u").select("g", F.col("v").alias("u"), F.col("m").alias("v")), "u", "v")
        low = _lowest(large)
        stars = materialize(up(low.select("g", "v", "m").union(low.select("g", F.col("u").alias("v"), "m")), "v", "m"))
        now = tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("g", "u", "v")), F.bit_xor(F.xxhash64("v", "u", "g"))).first())
        if now == seen:
            break
        seen = now
    root = stars.select(F.col("g").alias("_g"), F.col("u").alias("_u"), F.col("v").alias("root"))
    return nodes.join(root, F.col("g").eqNullSafe(F.col("_g")) & (F.col("node") == F.col("_u")), "left").select(
        "g", "node", F.coalesce("root", "node").alias("root"))
