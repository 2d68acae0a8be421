"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import Staging


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    found = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``u`` and the least node ``v`` of its component, for every node but the least ones.

    Large-star and small-star steps in turn, each written down, until neither changes an edge. Edges
    of one node are never gathered: only their least end is, which is summed up before it moves.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before, k = staging.write(edges, "edges-0"), None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges
        before, k = state, k + 1
        edges = staging.write(_small_star(_large_star(edges).distinct()).distinct(), f"edges-{k}")
