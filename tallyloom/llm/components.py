"""Connected components of a graph given as edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long, in any order, with repeats) to (node, component): the smallest node reachable, for
    each node of an edge.

    Each round hangs the larger neighbours of a node, then the smaller ones, on its smallest (large-star, small-star),
    which keeps components and ends in stars after about log2(n) rounds, whatever the shape. A node's smallest
    neighbour is one partial aggregate, so a hub costs no more than its edges; each round is written to the
    shared folder. Only the edges' count and a checksum reach the driver."""
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = materialize(now, "edges"), None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        now = hung.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least).distinct()
        now = materialize(now, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
