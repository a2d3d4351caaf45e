"""Connected components of an edge table by alternating stars, entirely in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them. Edges come as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). node and component (the smallest node reachable) of each node that has an edge to another."""
    edges = edges.selectExpr("greatest(u, v) as u", "least(u, v) as v").where("u <> v").distinct()
    edges = stored(edges, "edges")
    mark = None
    while True:
        large = stored(_large(edges), "edges")
        edges = stored(_small(large), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
