"""Connected components of an edge table by alternating large-star and small-star steps.

Only joins, aggregates and written checkpoints; nodes, edges and components stay distributed. Each
step replaces a node's edges by edges to the smallest neighbour, so a hub never meets itself squared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where(F.col("a") != F.col("b")).union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    # the sum wraps at 2**64; xor would lose pairs of equal rows, of which there are none
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b of one orderable type. Returns (node, component) for every node that has an
    edge to another one; component is the smallest node. Null ends, loops and repeated edges are ignored."""
    edges = edges.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    edges = cut_lineage(edges)
    before = None
    while (now := _state(edges)) != before:
        if now[0] == 0:
            break
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )
