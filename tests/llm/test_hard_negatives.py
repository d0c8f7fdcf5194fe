"""Hard negatives against all scores by force."""

import math

import duckdb
import numpy as np
import pytest

from gridlore.llm import hard_negatives as h


def force(rows):
    """``(vec_id, label, vector)`` to the contract's rows, in Python integers."""
    good = {}
    for i, label, vector in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1], r[2] if None not in r[2] else [])):
        if all(x is not None and math.isfinite(x) for x in vector):
            q = [math.floor(256 * float(x)) for x in vector]
            good.setdefault(i, ((label + 1) % 10 if i % 7 == 0 else label, q))
    out = []
    for a, (label, q) in good.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, o)), i, tag) for i, (tag, o) in good.items() if i != a)
        for p, positive, tag in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, positive, n, i, h._long(-p), h._long(-s)) for n, (s, i, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, tree string, place int")


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, width)) / math.sqrt(width)
    points = (middles[rng.integers(0, 12, n)] + rng.normal(size=(n, width)) * 0.1).astype(np.float32)
    points[::9] = points[0]  # many equal vectors: ties of score
    return [(i, int(rng.integers(0, 4)), p.tolist()) for i, p in enumerate(points)]


@pytest.mark.parametrize("tree, block", [(2048, 16_384), (3, 40)])
def test_every_window_is_filled_as_by_force(spark, monkeypatch, tree, block):
    monkeypatch.setattr(h, "STEP", 37)
    monkeypatch.setattr(h, "GROVE", 2)
    rows = clustered(700, 16, 1)
    rows += [(None, 1, [1.0] * 16), (50, None, [1.0] * 16), (1001, 1, None), (1002, 2, [float("nan")] * 16), (1003, 2, [None] * 16),
             (1004, 2, [float("inf")] * 16), (1005, 0, []), (1006, 0, [0.5, 0.25]), (1050, 3, [0.0] * 16), (-50, 1, [-0.3] * 16),
             rows[3], rows[3], (100, 0, rows[100][2])]
    got = sorted(tuple(r) for r in h.hard_negatives(table_of(spark, rows), tree, block).collect())
    assert got == force(rows) and len(got) > 100


def test_scores_beyond_doubles_are_exact(spark):
    rows = clustered(160, 8, 2)
    rows = [(i, label, [float(np.float32(x * 3e6)) for x in v]) for i, label, v in rows]
    assert sorted(tuple(r) for r in h.hard_negatives(table_of(spark, rows)).collect()) == force(rows)


def test_no_rows_no_anchor_no_other_label(spark):
    assert h.hard_negatives(table_of(spark, [])).count() == 0
    assert h.hard_negatives(table_of(spark, [(1, 1, [1.0]), (2, 2, [1.0])])).count() == 0
    assert h.hard_negatives(table_of(spark, [(50, 1, [1.0]), (2, 1, [1.0])])).count() == 0


def test_tree_is_minimal_and_bounds_spare_scores():
    rows = clustered(600, 16, 3)
    points = np.floor(256 * np.array([r[2] for r in rows]))
    labels, ids = np.array([r[1] for r in rows]), np.arange(600)
    order, parent, edge = h.spanning_tree(points[:60])
    away = np.sqrt(((points[:60, None] - points[None, :60]) ** 2).sum(axis=2))
    linked, total = {0}, 0.0
    while len(linked) < 60:
        d, new = min((away[i, j], j) for i in linked for j in range(60) if j not in linked)
        linked.add(new)
        total += d
    assert sorted(order) == list(range(60)) and abs(edge.sum() - total) < 1e-6 and parent[0] == -1
    anchors = points[:60][order]
    exact = anchors @ points.T
    windows = [[(int(s.max() * 0.5), int(s.max() * 0.95)), (int(s.max() * 0.4), int(s.max() * 0.6))] for s in exact]
    found, computed = h.tree_windows(anchors, labels[order], windows, parent, edge, points, labels, ids)
    for k, own in enumerate(windows):
        for (a, b), (scores, kept) in zip(own, found[k]):
            inside = sorted((-s, i) for i, s in enumerate(exact[k].tolist()) if a <= s <= b and labels[i] != labels[order[k]])[:3]
            assert list(zip(scores, kept)) == [(-s, i) for s, i in inside]
    assert computed < 0.6 * 60 * 600


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert sorted(tuple(r) for r in h.op12_hard_negatives(spark, folder).collect()) == sorted(con.sql(h.SQL).fetchall())
