"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.workdir import settle


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _distinct_edges(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct_edges(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge in ``edges(u, v)``; the root is the least node of its component.

    Each round writes its edges to the shared folder.  A node's neighbours are only ever aggregated, so a node of many edges
    is not gathered in one place.  Rounds grow with the logarithm of the longest path.
    """
    current, before = settle(_distinct_edges(edges.select("u", "v")), "edges"), None
    while True:
        current = settle(_small_star(_large_star(current)), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
