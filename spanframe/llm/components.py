"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); ``root`` is the least node of its component.

    Edges may repeat, point either way or be loops; null ends are left out,
    so they join nothing.  Nodes are compared in their own order.  Each round
    replaces the neighbours of a node by its least one, first for the larger
    neighbours (large star), then for the smaller (small star), until the
    edges are stars around their roots; rounds grow with the logarithm of a
    component's size.  Every step is a map-side combined minimum and an
    equi-join, which AQE can split when one node has most of the edges.
    """
    u, v = F.col("u"), F.col("v")
    e = materialise(edges.filter(u.isNotNull() & v.isNotNull() & (u != v))
                    .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter(v > u).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter(u != v).distinct()
        large = materialise(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(u != v) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = materialise(small)
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
