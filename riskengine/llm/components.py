"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the smallest one of its neighbourhood."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, F.col("u") == F.col("c"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and itself, is linked to the smallest one."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _settled(links: DataFrame) -> bool:
    """Whether links (u > v) are stars already: each u has one link and is nobody's v."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up")).union(links.select("v", F.lit(0)))
    per_vertex = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    return per_vertex.where("ups > 1 or ups = 1 and n > 1").isEmpty()


def components(links: DataFrame, tag: str = "components") -> DataFrame:
    """`id`, `component` (smallest id reachable) of every vertex of `links` (u, v) but the smallest.

    Each round moves all links at once and keeps no more than there are; the number of rounds grows
    with the logarithm of the longest path. Vertices without links are not returned.
    """
    now = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(now, tag, narrow=True)
    while not _settled(now):
        now = materialize(_small_star(_large_star(now)), tag, narrow=True)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
