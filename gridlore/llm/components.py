"""Connected components by alternating star contractions over written edge tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.session import materialize


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).distinct()


def _least(edges: DataFrame) -> DataFrame:
    """``u, m, settled`` of every node: the least of it and its neighbours, and whether it is a centre or has one neighbour only, its centre."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smaller = F.when(F.col("v") < F.col("u"), F.col("v"))
    each = both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.max(smaller).alias("other"))
    settled = F.col("other").isNull() | (F.col("other") == F.col("least")) & (F.col("most") < F.col("u"))
    return materialize(each.select("u", F.least("least", "u").alias("m"), settled.alias("settled")), "least")


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Points the larger neighbours of every node at the least of the node and its neighbours."""
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return materialize(larger.join(least.select("u", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    """Points every node and its smaller neighbours at the least of these."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def components(edges: DataFrame, contract: Callable[[DataFrame], DataFrame] = _distinct) -> DataFrame:
    """``node, component`` of every node that has an edge to another; the component is its least node.

    ``edges`` has columns ``u, v`` without nulls. Both inputs of every join are written tables, so Spark splits the
    rows of a hub over tasks; each round restarts from a table in the shared folder. ``contract`` replaces edges by as many or
    fewer, the larger node first, that connect the same nodes. The rows returned are a written table.
    """
    current = materialize(contract(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    while True:
        least = _least(current)
        if least.filter(~F.col("settled")).isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        moved = _small_star(_large_star(current, least))
        current = materialize(contract(materialize(moved, "moved")), "edges")
