"""Connected components of an edge list by alternating large and small stars.

Each round points every node at the smallest node it knows of, over joins and minima only; rounds needed grow
with the logarithm of the longest chain. Every table is stored between steps, so that Spark can split the rows
of a node with very many neighbours when it joins, and minima are combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbtide.session import materialise


def _smallest(pairs: DataFrame) -> DataFrame:
    """For node ``u`` the least of itself and its neighbours ``v``."""
    return materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    far = both.filter("v > u").join(_smallest(both), "u")
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = down.join(_smallest(down), "u")
    linked = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        near.select("u", F.col("m").alias("v")))
    return linked.filter("u <> v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (node, root): for each linked node the smallest node of its component.

    Loops and repeated links are allowed; roots are listed with themselves; no links give no rows.
    """
    edges = materialise(edges.select("u", "v").filter("u <> v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = materialise(_small_star(materialise(_large_star(edges), "large")), "small")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
