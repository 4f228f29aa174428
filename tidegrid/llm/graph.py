"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _both(edges: DataFrame) -> DataFrame:
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
        )
    )
    return edges.select(ends.alias("e")).select("e.u", "e.v")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the smallest node reached.

    Each round replaces every edge by one to a smaller neighbour, first among all neighbours, then
    among the smaller ones. The rounds end when the edges are stars around the roots; their number
    grows with the logarithm of the longest path. Every round is written to the shared folder.
    A self-loop makes a component of one node; null ends take no part.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null")
    loops = edges.where("a = b").select("a").distinct()
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    before = None
    while before != (state := _state(edges)):
        before = state
        sides = _both(edges)
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        star = down.join(low, "a")
        small = star.select(F.col("b").alias("a"), F.col("m").alias("b")).union(star.select("a", F.col("m").alias("b")))
        edges = materialize(small.where("a <> b").distinct(), "edges")
    stars = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return stars.union(roots).union(alone).groupBy("node").agg(F.min("root").alias("root"))
