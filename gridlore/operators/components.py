"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.operators import skew
from gridlore.operators.skew import hot_keys, split_join
from gridlore.session import materialize


def _with_least(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """Adds ``m``, the least node known at ``u``, to every edge; the edges of a hub are split over tasks."""
    if rows > skew.HOT_ROWS:
        least = materialize(least, "star-min")
    hot = hot_keys(least, ["u"], "n", rows)
    return split_join(edges, least.select("u", "m"), ["u"], hot, ["v"])


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of ``u`` is pointed at the least of ``u`` and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    moved = _with_least(both.filter(F.col("v") > F.col("u")), least, 2 * rows)
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """``u`` and its smaller neighbours are pointed at the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_least(down, least, rows)
    pointed = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v")))
    return pointed.filter(F.col("u") != F.col("v")).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge points at the centre of a star: each ``u`` once, and no ``v`` pointing further."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    centres = edges.select(F.col("v").alias("u")).distinct()
    return centres.join(edges.select("u"), "u", "left_semi").isEmpty()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, component`` for every row of ``nodes`` (column ``node``); the component is its least node.

    ``edges`` has columns ``u`` and ``v``. Each round is written to the shared folder, so lineage stays short
    and a lost executor costs one round at most.
    """
    current = materialize(edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star-edges")
    while not _is_stars(current):
        pointed = materialize(_large_star(current, current.count()), "star-edges")
        current = materialize(_small_star(pointed, pointed.count()), "star-edges")
    pointers = current.select(F.col("u").alias("node"), F.col("v").alias("_root"))
    return nodes.select("node").join(pointers, "node", "left").select(
        "node", F.coalesce("_root", "node").alias("component"))
