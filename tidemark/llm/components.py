"""Connected components by alternating large-star and small-star rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import saved


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the least of u's neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and every neighbour below it are tied to the least of those."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    ties = down.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return ties.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every end of links (a, b); component is the least node reachable.

    Loops and repeated links are ignored; rows with a null end too.  Hubs are only ever reduced to a
    minimum, never gathered.  Each round is written to the shared folder, so lineage stays short.
    """
    edges = saved(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or not mark.n:
            break
        before = mark
        edges = saved(_small(_large(edges)).select("a", "b"), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
