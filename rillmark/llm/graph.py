"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and the least node it is linked with, directly or through others (``component``), for every node that has a link.

    ``links`` has columns ``a`` and ``b``. Large-star and small-star steps alternate until the links are stars around their least nodes; a node with very many
    links is reduced to its least neighbour before rows move.
    """
    edges = staged(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours are tied to the least of the neighbourhood.
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a != b").distinct()
        # Smaller neighbours and the node itself are tied to the least smaller neighbour.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        tied = large.join(least, "b")
        small = tied.select(F.col("m").alias("a"), "b").union(tied.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()
        new = staged(small, "edges")
        if mark(new) == mark(edges):
            return new.select(F.col("b").alias("node"), F.col("a").alias("component")).union(new.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        edges = new


def mark(edges: DataFrame) -> tuple:
    """Number of links and sum of their hashes: equal for equal sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
