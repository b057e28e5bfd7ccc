"""Connected components of an edge table, as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014): every step replaces a node's
edges by edges to the smallest neighbour it knows, so the edge count never
grows and a path of n nodes needs O(log n) rounds. Each round is written to
the shared checkpoint folder; only its count and checksum reach the driver. The
smallest neighbours are written before edges are joined to them, so that adaptive
execution can split a node with many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    low = materialize(low, "cc-low")
    return (both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``: root is the smallest
    node reachable. Nodes without an edge are not listed. Raises if the rounds
    do not settle (a path of 2**60 nodes would)."""
    now = materialize(edges.select("u", "v").filter("u <> v").distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        now = materialize(_small_star(_large_star(now)), "cc")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == seen:
            stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
        seen = tuple(mark)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
