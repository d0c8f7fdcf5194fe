"""Hard negatives by anchor spanning trees: a parent's scores bound its children's, only rows that may lie in a window are rescored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlore.llm.common import partitions, table
from gridlore.session import materialize

#: Every so many ids one is an anchor.
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: A negative scores from ``LOW`` to ``HIGH`` percent of the positive.
LOW, HIGH = 50, 95
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Most anchors of a tree and rows of a block, on average; trees that meet a block in one task; rows of a block that walk a tree together.
TREE, BLOCK, GROVE, STEP = 2048, 16_384, 8, 1024
#: Sums of integers below this are exact as double.
EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part.

    Rows with a null id, label or vector or with a null or non-finite component do not. Of rows of one id the least by label,
    then vector stays, so equal rows count once. Other columns are not read.
    """
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").dropna().filter(good)
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r"))
    return one.select("vec_id", "r.label", "r.embedding")


def matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """The scaled vectors as rows of whole numbers; shorter vectors end in zeros.

    Doubles while every score is exact as double, else Python integers.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    sizes = np.diff(at)
    flat = np.floor(SCALE * column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.float64))
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _whole(*parts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The matrices with one width, as doubles if all scores between them are exact, else as Python integers."""
    width = max(p.shape[1] for p in parts)
    most = max(float(np.abs(p).max(initial=0)) for p in parts)
    parts = tuple(np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts)
    if most * most * width < EXACT:
        return parts
    big = np.frompyfunc(int, 1, 1)
    return tuple(big(p) if p.size else p.astype(object) for p in parts)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent's place in it (-1 for the root) and edge length of a minimum spanning tree (Prim)."""
    n = len(points)
    points = points.astype(np.float64)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, by, open_ = np.full(n, np.inf), np.full(n, -1), np.ones(n, dtype=bool)
    now = 0
    for place in range(n):
        order[place], parent[place], open_[now] = now, by[now], False
        edge[place] = 0.0 if place == 0 else near[now]
        away = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        closer = open_ & (away < near)
        near[closer], by[closer] = away[closer], place
        if place + 1 < n:
            now = int(np.argmin(np.where(open_, near, np.inf)))
    return order, parent, edge


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    """Places of the tree by distance from the root."""
    depth = np.zeros(len(parent), np.int64)
    for place in range(1, len(parent)):
        depth[place] = depth[parent[place]] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(parent) else []


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by id; ``ids`` rise. Exact, with no full sort."""
    if len(scores) > n and scores.dtype != object:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        among = np.flatnonzero(scores >= least)
        return among[np.argsort(-scores[among], kind="stable")[:n]]
    return np.argsort(-scores, kind="stable")[:n]


def _merged(old: tuple[list, list], scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[list, list]:
    """The ``n`` best of those found so far and the new ones."""
    pairs = sorted([*zip(old[0], old[1]), *zip(scores.tolist(), ids.tolist())], key=lambda p: (-p[0], p[1]))[:n]
    return [p[0] for p in pairs], [p[1] for p in pairs]


def tree_windows(anchors: np.ndarray, labels: np.ndarray, windows: list[list[tuple[int, int]]], parent: np.ndarray, edge: np.ndarray,
                 rows: np.ndarray, row_labels: np.ndarray, row_ids: np.ndarray, n: int = NEGATIVES) -> tuple[list[list[tuple[list, list]]], int]:
    """For every anchor and each of its windows the ``n`` best rows of other labels, and how many scores were computed.

    The root is scored against every row. A child's score differs from its parent's by at most the edge's length times the
    row's norm; rows whose interval meets none of the child's windows, or lies below what all of them already hold, pass
    the interval on unscored.
    """
    found = [[([], []) for _ in own] for own in windows]
    computed, levels = 0, _levels(parent)
    by_id = np.argsort(row_ids, kind="stable")
    rows, row_labels, row_ids = rows[by_id], row_labels[by_id], row_ids[by_id]
    every = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    for first in range(0, len(rows), STEP):
        some, tags, ids, norms = (x[first:first + STEP] for x in (rows, row_labels, row_ids, every))
        low, high = np.zeros((len(parent), len(some))), np.zeros((len(parent), len(some)))
        for level in levels:
            if parent[level[0]] < 0:
                possible = np.ones((1, len(some)), dtype=bool)
            else:
                slack = edge[level][:, None] * norms * (1 + 1e-9)
                low[level], high[level] = low[parent[level]] - slack - 1, high[parent[level]] + slack + 1
                floor, ceiling = np.full(len(level), np.inf), np.full(len(level), -np.inf)
                for k, place in enumerate(level):
                    for (a, b), kept in zip(windows[place], found[place]):
                        if a <= b:
                            floor[k] = min(floor[k], max(a, kept[0][-1]) if len(kept[0]) == n else a)
                            ceiling[k] = max(ceiling[k], b)
                possible = (high[level] >= floor[:, None]) & (low[level] <= ceiling[:, None]) & (tags != labels[level][:, None])
            which, at = np.nonzero(possible)
            if not len(which):
                continue
            wide = len(which) > possible.size // 4  # then one product is cheaper than the pairs one by one
            scores = (anchors[level] @ some.T)[which, at] if wide or anchors.dtype == object else np.einsum("ij,ij->i", anchors[level[which]], some[at])
            computed += len(which)
            low[level[which], at] = high[level[which], at] = scores.astype(np.float64)
            if anchors.dtype == object:  # a score beyond 2**53 is rounded as double
                low[level[which], at], high[level[which], at] = np.nextafter(low[level[which], at], -np.inf), np.nextafter(high[level[which], at], np.inf)
            cuts = np.searchsorted(which, np.arange(len(level) + 1))
            for k, place in enumerate(level):
                mine, there = scores[cuts[k]:cuts[k + 1]], at[cuts[k]:cuts[k + 1]]
                if not len(mine):
                    continue
                for w, (a, b) in enumerate(windows[place]):
                    inside = np.flatnonzero(((mine >= a) & (mine <= b) & (tags[there] != labels[place])).astype(bool))
                    if len(inside):
                        take = inside[best(mine[inside], ids[there[inside]], n)]
                        found[place][w] = _merged(found[place][w], mine[take], ids[there[take]], n)
    return found, computed


def _trees(anchors: DataFrame) -> DataFrame:
    """Adds ``place, parent, edge`` in the spanning tree of the anchor's group ``tree``."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        order, parent, edge = spanning_tree(matrix(group["embedding"]))
        group = group.take(pa.array(order))
        return (group.append_column("place", pa.array(np.arange(len(order)))).append_column("parent", pa.array(parent))
                .append_column("edge", pa.array(edge)))

    fields = "vec_id long, label long, embedding array<float>, tree int, place long, parent long, edge double"
    return anchors.groupBy("tree").applyInArrow(run, fields)


def _cells(anchors: DataFrame, rows: DataFrame, blocks: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns ``grove, block`` of the cells they meet in: every ``GROVE`` trees meet every block."""
    return (anchors.withColumn("grove", F.expr(f"tree div {GROVE}").cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))),
            rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
            .withColumn("grove", F.explode(F.sequence(F.lit(0), F.lit((trees - 1) // GROVE)))))


def _out(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table({f.name: pa.array(c, type=f.type) for f, c in zip(schema, columns)}, schema=schema)


def _long(score) -> int:
    return min(max(int(score), _LEAST), _MOST)


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                       ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _positives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The best rows of the anchor's label within a cell."""
    if not left.num_rows or not right.num_rows:
        return _POSITIVE.empty_table()
    right = right.sort_by("vec_id")
    a, r = _whole(matrix(left["embedding"]), matrix(right["embedding"]))
    ids, tags, anchor_ids, labels = (t[c].to_numpy() for t in (right, left) for c in ("vec_id", "label"))
    out = []
    for label in np.unique(labels).tolist():
        own, same = np.flatnonzero(labels == label), np.flatnonzero(tags == label)
        for first in range(0, len(own), 256) if len(same) else ():
            part = own[first:first + 256]
            for anchor, scores in zip(anchor_ids[part].tolist(), a[part] @ r[same].T):
                others = np.flatnonzero(ids[same] != anchor)
                for k in others[best(scores[others], ids[same[others]], POSITIVES)]:
                    out.append((anchor, int(ids[same[k]]), _long(scores[k])))
    return _out(_POSITIVE, out)


def _negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The best rows within each window of a cell's anchors."""
    if not left.num_rows or not right.num_rows:
        return _NEGATIVE.empty_table()
    a, r = _whole(matrix(left["embedding"]), matrix(right["embedding"]))
    ids, tags = right["vec_id"].to_numpy(), right["label"].to_numpy()
    trees, places = left["tree"].to_numpy(), left["place"].to_numpy()
    anchor_ids, labels, parent, edge = (left[c].to_numpy() for c in ("vec_id", "label", "parent", "edge"))
    positives, out = left["positives"].to_pylist(), []
    for tree in np.unique(trees).tolist():
        own = np.flatnonzero(trees == tree)
        own = own[np.argsort(places[own])]
        windows = [[(-(-LOW * p["positive_score"] // 100), HIGH * p["positive_score"] // 100) for p in positives[k] or ()] for k in own]
        found, _ = tree_windows(a[own], labels[own], windows, parent[own], edge[own], r, tags, ids)
        out += [(int(anchor_ids[k]), p["positive_id"], p["positive_score"], int(i), _long(score))
                for k, held in zip(own, found) for p, kept in zip(positives[k] or (), held) for score, i in zip(*kept)]
    return _out(_NEGATIVE, out)


def _meet(anchors: DataFrame, rows: DataFrame, run, schema: pa.Schema) -> DataFrame:
    fields = ", ".join(f"{f.name} long" for f in schema)
    return anchors.groupBy("grove", "block").cogroup(rows.groupBy("grove", "block")).applyInArrow(run, fields)


def _ranked(df: DataFrame, group: list[str], score: str, tie: str, n: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(embeddings: DataFrame, tree: int = TREE, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the vectors scaled by ``SCALE`` and rounded down; a shorter vector ends in zeros, and a score
    beyond 64 bits counts as the nearest long. Anchors are dealt by id into trees of about ``tree``, rows into blocks of
    about ``block``, and every ``GROVE`` trees meet every block in a task of their own, so a task's size does not depend on the
    data; only the few best of every cell go on. An anchor without positives or a positive without negatives gives no row.
    """
    rows = vectors(embeddings)
    kind = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialize(rows.select("vec_id", kind.alias("label"), F.col("embedding").cast("array<float>").alias("embedding")), "vectors")
    chosen = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    trees = max(1, -(-chosen.count() // tree))
    blocks = max(1, min(partitions(rows.sparkSession), -(-rows.count() // 1024)), -(-rows.count() // block))
    grown = materialize(_trees(chosen.withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(trees)).cast("int"))), "trees")
    left, right = _cells(grown, rows, blocks, trees)
    near = _ranked(_meet(left, right, _positives, _POSITIVE), ["anchor_id"], "positive_score", "positive_id", POSITIVES).drop("rank")
    own = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    aimed = materialize(grown.join(own, "vec_id", "left"), "aimed")
    left, right = _cells(aimed, rows, blocks, trees)
    out = _ranked(_meet(left, right, _negatives, _NEGATIVE), ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH finite AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT vec_id, label, q FROM finite WHERE vec_id % {ANCHOR_EVERY} = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(r.q AS DOUBLE[])) AS BIGINT) AS score
  FROM anchors a JOIN finite r ON a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.row_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
