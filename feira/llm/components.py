"""Connected components by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and a join whose large
partitions Spark can split, so a node with very many neighbours is never one task's
group. Each round is written, so a lost executor costs one round. Rounds end as soon as
the edges are stars, which one count per node tells; no round is run to see that nothing
changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import written


def _oriented(u, v) -> list:
    return [F.greatest(u, v).alias("u"), F.least(u, v).alias("v")]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    moved = both.join(least, F.col("u") == F.col("w")).where("v > u")
    return moved.select(*_oriented(F.col("v"), F.col("m"))).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("w"))
    # the edge to the smallest neighbour stands for the node itself
    node = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return moved.select(node.alias("u"), F.col("m").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has edges to larger nodes only, or one edge to a smaller node.

    edges: distinct (u, v) with u > v.
    """
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1 and up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; component: its smallest reachable node.

    edges: two bigint columns, named in any way; order, repeats and loops don't matter.
    Rows with a null end link nothing.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    edges = written(edges.where(a != b).select(*_oriented(a, b)).distinct(), "edges")
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
