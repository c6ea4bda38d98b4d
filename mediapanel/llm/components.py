"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node move to the smallest of them.
    Large: the larger neighbours of every node; small: the smaller ones, and
    the node itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where(F.col("v") < F.col("u"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, root): the smallest node reachable from every linked node, for
    ``links`` (u, v) of longs. Edges stay a table that is written anew each
    round; the number of rounds grows with the logarithm of the longest chain."""
    edges = (links.where(F.col("u") != F.col("v"))
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = written(edges, "links")
    mark = None
    while True:
        edges = written(_star(_star(edges, True), False), "links")
        # Stars only: every edge leads to a root, and no root has an edge.
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = edges.select(F.col("v").alias("u")).distinct()
    return edges.select("u", F.col("v").alias("root")).unionByName(roots.select("u", F.col("u").alias("root")))
