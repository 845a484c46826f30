"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import settled


def _smallest(pairs: DataFrame) -> DataFrame:
    """For pairs (u, v): u with the smallest v or u itself. A grouping that folds before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _downward(pairs: DataFrame) -> DataFrame:
    """Different pairs from the larger to the smaller node, written."""
    return settled(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none if another node's edge ends at it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up + low > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node of ``edges`` (columns u, v).

    Each round joins every node's neighbours to the smallest of them, first over larger neighbours, then
    over smaller ones; rounds grow with the logarithm of the longest path. Neighbours are never collected:
    a round is a minimum per node joined back to the edges, so a hub is an ordinary skewed join key.
    Self-loops, repeated edges and an empty table are allowed.
    """
    edges = _downward(edges)
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = low.where("u <> v")
        at = at.join(_smallest(at), "u")
        edges = _downward(at.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(at.select("u", F.col("m").alias("v"))))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
