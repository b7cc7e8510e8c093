"""Connected components of links between numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # Written, so that the join deals both sides anew and Spark can split a node with very many neighbours.
    least = cut_lineage(least.select("u", F.least("u", "m").alias("m")))
    greater = both.where("v > u").join(least, "u")
    return greater.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for each linked number but the least of its component, which is v.

    ``edges`` are pairs u > v. Neighbours are never gathered: each step is an aggregation to one value per
    node and an equi-join. The number of steps grows with the logarithm of the longest chain. Every step is
    written to the shared folder.
    """
    edges, before = cut_lineage(edges.distinct()), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))).first()
        if not now[0] or now == before:
            return edges
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
