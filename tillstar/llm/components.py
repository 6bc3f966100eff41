"""Connected components of a graph of links, by alternating large and small stars on stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node with a link: the root is the smallest node it reaches.

    Nodes are of any ordered type. Each round points every neighbour of a node at the smallest of them, first
    the larger ones, then the smaller ones, until nothing changes; the number of rounds grows with the logarithm
    of the size, and every round's edges are stored, so no lineage builds up. Minima are aggregated in the map
    tasks and joined back, so a node with very many links is no single task's work. No links give no rows.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        # Roots and edges no longer change when every edge points at a node that points nowhere.
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
    tops = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        tops.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node linked to the smallest node of its neighbourhood."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = around.filter("v > u").join(lowest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, linked to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
