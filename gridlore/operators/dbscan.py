"""Density clustering of 2-D points, distributed and exact.

Cells have a diagonal of ``eps``, so points of one cell are always neighbours. A cell with ``min_samples`` points
therefore holds core points only and none of its inner pairs is ever looked at; other cells hold fewer than
``min_samples`` points, which bounds the pairs formed with them. Cells, not points, are the nodes of the graph whose
connected components are the clusters.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.operators.components import connected_components
from gridlore.operators.ranks import positions
from gridlore.operators.skew import hot_keys, split_join
from gridlore.session import materialize

CELL = ["cx", "cy"]
# cells are a hair smaller than eps / sqrt(2), so that rounding cannot put a cell's points further apart than eps
SHRINK = 1 - 1e-6
# cells whose points can be within eps: two steps each way; by that hair the far corners are among them
REACH = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
# point pairs formed directly for one pair of boxes; larger ones are cut into smaller boxes first
DIRECT_PAIRS = 1024
SUBDIVIDE = 4


def _close(ax: Column, ay: Column, bx: Column, by: Column, eps: float) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by) <= eps * eps


def _checked(c: str) -> Column:
    bad = F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return F.when(bad, F.raise_error(F.lit(f"{c} must be a finite number")).cast("double")).otherwise(F.col(c))


def _near_cells(df: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """One row per reachable cell, named ``cx, cy``; the own cell moves to ``ox, oy``."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])
    rest = [c for c in df.columns if c not in CELL]
    return (df.withColumn("_s", F.explode(steps))
            .select(*rest, F.col("cx").alias("ox"), F.col("cy").alias("oy"),
                    (F.col("cx") + F.col("_s.i")).alias("cx"), (F.col("cy") + F.col("_s.j")).alias("cy")))


def _boxes(points: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box, one member and the number of distinct places per group."""
    return points.groupBy(*keys).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min(F.struct("x", "y")).alias("rep"), F.count("*").alias("n"))


def _judge(pairs: DataFrame, eps: float) -> DataFrame:
    """``linked``: true, false, or null while the boxes do not tell. Boxes are prefixed a_ and b_."""
    def gap(lo: str, hi: str) -> Column:
        return F.greatest(F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.lit(0.0))

    def span(lo: str, hi: str) -> Column:
        return F.greatest(F.col(f"a_{hi}") - F.col(f"b_{lo}"), F.col(f"b_{hi}") - F.col(f"a_{lo}"))
    e2 = eps * eps
    gx, gy, sx, sy = gap("x0", "x1"), gap("y0", "y1"), span("x0", "x1"), span("y0", "y1")
    touching = _close(F.col("a_rep.x"), F.col("a_rep.y"), F.col("b_rep.x"), F.col("b_rep.y"), eps)
    return pairs.withColumn("linked", F.when((sx * sx + sy * sy <= e2) | touching, True)
                            .when(gx * gx + gy * gy > e2, False))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _prefixed_keys(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def _cell_links(cores: DataFrame, cells: DataFrame, eps: float, side: float) -> DataFrame:
    """Pairs ``u, v`` of core cells (by node) that hold core points within eps of each other.

    Boxes settle most pairs. The rest is compared point by point where few points are involved, otherwise cut
    into smaller boxes and judged again, so that two dense cells never meet point by point as a whole.
    """
    forward = [(i, j) for i, j in REACH if (i, j) > (0, 0)]
    near = _near_cells(cells, forward).withColumnsRenamed({c: f"a_{c}" for c in cells.columns if c not in CELL})
    found = near.join(_prefixed(cells, "b_").withColumnsRenamed({"b_cx": "cx", "b_cy": "cy"}), CELL)
    pairs = materialize(_judge(found.drop("ox", "oy", "cx", "cy"), eps).filter("linked is not false"), "dbscan-pairs")
    points = materialize(cores.select("node", "x", "y").distinct(), "dbscan-points")
    hot = hot_keys(cells, ["node"], "n", points.count())
    keys = ["node"]
    links = pairs.filter("linked").select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))
    depth = 0
    while True:
        open_pairs = pairs.filter("linked is null")
        small = F.col("a_n") * F.col("b_n") <= DIRECT_PAIRS
        a_keys, b_keys = [f"a_{k}" for k in keys], [f"b_{k}" for k in keys]
        half = split_join(_prefixed(points, "a_"), open_pairs.filter(small).select(*a_keys, *b_keys), a_keys,
                          hot and _prefixed_keys(hot, keys, "a_"), ["a_x", "a_y"])
        direct = split_join(_prefixed(points, "b_"), half, b_keys,
                            hot and _prefixed_keys(hot, keys, "b_"), ["b_x", "b_y"])
        direct = direct.filter(_close(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y"), eps))
        links = materialize(
            links.unionByName(direct.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))).distinct(),
            "dbscan-links")
        # a pair of cells already linked needs no further look
        settled = links.select(F.col("u").alias("a_node"), F.col("v").alias("b_node"))
        large = materialize(open_pairs.filter(~small).select(*a_keys, *b_keys)
                            .join(settled, ["a_node", "b_node"], "left_anti"), "dbscan-open")
        if large.isEmpty():
            return links
        depth += 1
        unit = side / SUBDIVIDE ** depth
        sub = [f"sx{depth}", f"sy{depth}"]
        ends = large.select(*[F.col(f"a_{k}").alias(k) for k in keys]).unionByName(
            large.select(*[F.col(f"b_{k}").alias(k) for k in keys])).distinct()
        points = materialize(split_join(points, ends, keys, hot, ["x", "y"], "left_semi").withColumns({
            sub[0]: F.floor(F.col("x") / unit), sub[1]: F.floor(F.col("y") / unit)}), "dbscan-points")
        finer = [*keys, *sub]
        boxes = materialize(_boxes(points, finer), "dbscan-boxes")
        hot = hot_keys(boxes, finer, "n", points.count())
        pairs = (large.join(_prefixed(boxes, "a_"), a_keys).join(_prefixed(boxes, "b_"), b_keys))
        pairs = materialize(_judge(pairs, eps).filter("linked is not false"), "dbscan-pairs")
        keys = finer
        links = materialize(links.unionByName(
            pairs.filter("linked").select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))).distinct(),
            "dbscan-links")
        pairs = pairs.join(links.select(F.col("u").alias("a_node"), F.col("v").alias("b_node")),
                           ["a_node", "b_node"], "left_anti")


def dbscan(df: DataFrame, row_id: str, x: str, y: str, eps: float = 0.5, min_samples: int = 5,
           out: str = "cluster_dbscan") -> DataFrame:
    """``row_id`` and its cluster: 0, 1, ... in order of each cluster's least core row, -1 for noise.

    A border point goes to the first cluster that reaches it. ``row_id`` is a unique whole number.
    """
    side = eps / sqrt(2.0) * SHRINK
    points = df.select(F.col(row_id).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    points = points.withColumns({"x": _checked("x"), "y": _checked("y")})
    points = materialize(points.withColumns({
        "cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}), "dbscan-points")

    counts = materialize(points.groupBy(*CELL).agg(F.count("*").alias("n")), "dbscan-cells")
    hot = hot_keys(counts, CELL, "n", points.count())
    tagged = split_join(points, counts, CELL, hot, ["id"])
    dense, sparse = tagged.filter(F.col("n") >= min_samples), tagged.filter(F.col("n") < min_samples)

    # neighbours outside the own cell; at most min_samples - 1 points per sparse cell ask
    asking = _near_cells(sparse.drop("n"), [o for o in REACH if o != (0, 0)])
    asking = asking.withColumnsRenamed({"id": "a_id", "x": "a_x", "y": "a_y"}).drop("ox", "oy")
    met = split_join(points, asking, CELL, hot, ["id"]).filter(
        _close(F.col("a_x"), F.col("a_y"), F.col("x"), F.col("y"), eps))
    outside = met.groupBy(F.col("a_id").alias("id")).agg(F.count("*").alias("_out"))
    judged = sparse.join(outside, "id", "left").withColumn(
        "core", F.col("n") + F.coalesce("_out", F.lit(0)) >= min_samples).drop("_out")
    judged = materialize(judged.unionByName(dense.withColumn("core", F.lit(True))), "dbscan-judged")

    cores = judged.filter("core").select("id", "x", "y", *CELL)
    nodes = cores.groupBy(*CELL).agg(F.min("id").alias("node"))
    boxes = _boxes(cores.select(*CELL, "x", "y").distinct(), CELL)
    cells = materialize(boxes.join(nodes, CELL), "dbscan-core-cells")
    core_points = materialize(split_join(cores, cells.select(*CELL, "node"), CELL, hot, ["id"]), "dbscan-cores")

    links = _cell_links(core_points, cells, eps, side)
    component = materialize(connected_components(cells.select("node"), links), "dbscan-components")
    order = positions(component.select("component").distinct(), "component", out)
    numbered = materialize(
        component.join(order, "component").select("node", out).join(cells.select("node", *CELL), "node"),
        "dbscan-clusters").select(*CELL, out)

    core_rows = split_join(cores, numbered, CELL, hot, ["id"]).select("id", out)
    loose = judged.filter("not core").select("id", "x", "y", *CELL)
    asking = _near_cells(loose, REACH).withColumnsRenamed({"id": "a_id", "x": "a_x", "y": "a_y"}).drop("ox", "oy")
    # the cluster belongs to the cell, so it is joined to the few asking points, not to the many cores
    asking = asking.join(numbered, CELL)
    border = (split_join(cores, asking, CELL, hot, ["id"])
              .filter(_close(F.col("a_x"), F.col("a_y"), F.col("x"), F.col("y"), eps))
              .groupBy(F.col("a_id").alias("id")).agg(F.min(out).alias(out)))
    loose_rows = loose.select("id").join(border, "id", "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))
    return core_rows.unionByName(loose_rows).select(F.col("id").alias(row_id), F.col(out).cast("int").alias(out))
