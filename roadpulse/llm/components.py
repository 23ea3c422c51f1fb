"""Connected components of a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import staged


def _print(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest around that node."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node.

    Each round is two joins on counts summed before the shuffle, written to the shared
    folder; the number of rounds grows with the logarithm of the longest path. The driver
    sees a count and a checksum per round.
    """
    tidy = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(tidy.distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.toDF("node", "component").union(roots)
