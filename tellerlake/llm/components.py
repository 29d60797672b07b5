"""Connected components by alternating stars, as joins and minima.

Edges are rewired until every node hangs on the smallest node of its component: a large
star moves a node's larger neighbours to its smallest neighbour, a small star its smaller
ones. A hub is never gathered: its minimum combines before the shuffle, and its edges meet
that minimum in a join that adaptive execution splits. Every round is written to the
shared folder, so a lost executor costs a part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.shared import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame) -> DataFrame:
    """`pairs` (u, v) with the minimum of u's neighbours and u itself."""
    least = pairs.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    joined = pairs.join(least, F.col("u") == F.col("m_u"))
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has larger neighbours only, or one neighbour. Then a neighbour that is
    smaller has larger ones only, so each component is a star round its smallest node."""
    near = _both(edges).groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return near.where("m < u and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of `edges` (a, b)."""
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc"
    )
    while not _all_stars(edges):
        # copies of an edge change no minimum, so one distinct a round is enough
        large = _star(_both(edges)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _star(large)
        small = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))
        )).alias("e")).select("e.*").where("u <> v").distinct()
        edges = written(small, "cc")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def joined_components(known: DataFrame, more: DataFrame) -> DataFrame:
    """`known` (node, component) with components joined by `more`, edges (a, b) between components.

    A node that `known` does not have is a component of its own.
    """
    upper = components(more)
    up = upper.select(F.col("node").alias("c"), F.col("component").alias("higher"))
    moved = known.join(up, F.col("component") == F.col("c"), "left")
    moved = moved.select("node", F.coalesce("higher", "component").alias("component"))
    return moved.unionByName(upper.join(known.select("node"), "node", "left_anti"))
