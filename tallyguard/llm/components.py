"""Connected components of a table of links by alternating large and small stars, every round stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.session import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link every neighbour (the larger ones, or the smaller ones) to the smallest node of the star."""
    if larger:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(least, "u")
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the component's smallest node.

    Ties, repeated links and loops make no difference; no links give no rows.
    """
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                   .where(F.col("u") != F.col("v")).distinct(), "links")
    mark = None
    while True:
        edges = stored(_star(_star(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
