"""Connected components of a distributed edge list, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the least node of its component) for each node of an edge (a, b); longs, no nulls.

    Large-star: each node's greater neighbours are tied to its least neighbour. Small-star: its smaller neighbours and itself are
    tied to the least. Both are an aggregate to the least neighbour, and a join of the edges with that one row: a neighbourhood is streamed
    through a task and never held there, and a hub's edges, two numbers each, are split over tasks by adaptive execution where they are too
    many for one. Both alternate until nothing changes; the number of edges never grows.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        both = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(least, "a").select(F.explode(both).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        old, edges = edges, materialize(small, "cc")
        discard(old)
        # Done when every node hangs on a root and no root hangs on another: a sum over the edges no longer changes.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
