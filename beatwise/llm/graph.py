"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


#: Edges of one file of a round's table.
FILE_EDGES = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every neighbour above a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return both.join(least, "a").filter("b > a").select(
        F.least("least", "a").alias("x"), "b").filter("x != b").select(F.col("x").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its neighbours below it to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(least, "b")
    return moved.select(F.col("least").alias("a"), "b").union(
        moved.select(F.col("least").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``, a < b; root is the smallest node.

    Both stars only use combinable minima, equi-joins and ``distinct``; the
    edge table is written to shared storage each round and shrinks to stars in
    a number of rounds that grows with the logarithm of the longest path.
    Stars never have more rows than the edges, so their count bounds the files
    of a round.  No rows: no rows.
    """
    files = edges.count() // FILE_EDGES + 1
    current, mark = edges, None
    while True:
        current = materialize(_small_star(_large_star(current)), "stars", files)
        seen = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                           F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
