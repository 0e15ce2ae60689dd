"""Connected components of links, by alternating stars; every step is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end (``a``) has one edge and is no smaller end (``b``) of another: then ``b`` is its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges (``a, b``): the smallest node that can be reached.

    No group of neighbours is collected: a hot node costs as many rows as it has edges.  The number of rounds is
    logarithmic in the longest path; links that are stars already, as of components found before, need none.  A round keeps
    what is connected, so stars are the components.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
