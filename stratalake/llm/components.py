"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) for every end of a link (``a``, ``b``).

    Every round hangs neighbours on smaller neighbours, until each component is one star. Sums of
    neighbours are combined before they are shuffled, and no neighbourhood is ever collected.
    """
    edges = stored(_ordered(links), "links")
    while not _all_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller end."""
    pair = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.distinct()


def _all_stars(edges: DataFrame) -> bool:
    """True when no node has two smaller neighbours, nor a smaller and a larger one."""
    lower = edges.select(F.col("a").alias("v"), F.lit(1).alias("lower"), F.lit(0).alias("upper"))
    upper = edges.select(F.col("b").alias("v"), F.lit(0).alias("lower"), F.lit(1).alias("upper"))
    sides = lower.unionByName(upper).groupBy("v").agg(F.sum("lower").alias("lower"), F.max("upper").alias("upper"))
    return sides.where("lower + upper > 1 AND lower > 0").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.where("a <> b").unionByName(own).distinct()
