"""Connected components of an edge table by alternating large and small stars
(Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def _with_min(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours v. A grouped minimum
    (combined before the shuffle) joined back; a hub's rows can be split."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(low.select("u", F.least("u", "m").alias("m")), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``: root is the smallest node
    of its component. No edge table or component reaches the driver; each round
    writes the (shrinking) stars to the shared folder. Self-loops and NULL ends
    are ignored; an empty table gives an empty one."""
    cur = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                             F.least("u", "v").alias("v")).distinct(), "edges")
    last = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _with_min(large)            # large only links a node to smaller ones
        new = stage(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(small.select("u", F.col("m").alias("v")))
                    .where("u <> v").distinct(), "stars")
        unstage(cur)
        cur = new
        # done when the edges are stars that did not change
        sign = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if tuple(sign) == last:
            break
        last = tuple(sign)
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
