"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one node that hangs below none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (columns a, b): node and component, the least node it is linked with.

    Each round hangs every node's larger neighbours below its least neighbour, then the smaller ones; the
    number of rounds grows with the logarithm of the longest chain. Links never leave the executors; a
    round is written to the shared folder. Nulls and links of a node to itself are ignored. A node with
    many links is spread by the engine's skew handling, as its partner table has one row per node.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).union(least).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", F.col("v").alias("w")).distinct()
    )
