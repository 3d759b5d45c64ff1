"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) for every linked node but the smallest of its component, which is b.

    ``edges`` holds pairs with a > b.  Smallest neighbours are found by
    aggregation and joined back, so a node of any degree is spread over tasks.
    Each round is written to the shared folder, which cuts the lineage; the
    number of rounds grows with the logarithm of the nodes.
    """
    edges = stored(edges.distinct(), "links")
    while True:
        forks = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        chains = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if not forks.take(1) and not chains.take(1):
            return edges
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "stars")
