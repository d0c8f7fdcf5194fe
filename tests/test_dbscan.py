import random

import pytest
from pyspark.sql import functions as F

from gridlore.operators import components, dbscan as module, ranks, skew
from gridlore.operators.dbscan import dbscan


def brute_force(points, eps, min_samples):
    """First-visit labelling over all pairs."""
    near = {i: [j for j, b in points.items() if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= eps * eps]
            for i, a in points.items()}
    core = {i for i in points if len(near[i]) >= min_samples}
    label, cluster = {}, 0
    for i in sorted(points):
        if i in label or i not in core:
            continue
        stack, label[i] = [i], cluster
        while stack:
            for j in near[stack.pop()]:
                if j not in label:
                    label[j] = cluster
                    if j in core:
                        stack.append(j)
        cluster += 1
    return {i: label.get(i, -1) for i in points}


def run(spark, points, eps, min_samples):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in points.items()], "id bigint, x double, y double")
    return {r["id"]: r["cluster_dbscan"] for r in dbscan(df, "id", "x", "y", eps, min_samples).collect()}


def blobs(seed, n, spread):
    rng = random.Random(seed)
    centres = [(0, 0), (3, 1), (1.5, 4)]
    out = {}
    for i in rng.sample(range(n * 10), n):
        cx, cy = rng.choice(centres)
        out[i] = (rng.gauss(cx, spread), rng.gauss(cy, spread)) if rng.random() < 0.9 else (rng.uniform(-3, 6), rng.uniform(-3, 7))
    return out


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(module, "DIRECT_PAIRS", 4)
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(skew, "FANOUT", 3)
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 10)


@pytest.mark.parametrize("seed,spread", [(1, 0.3), (2, 0.6)])
def test_blobs(spark, seed, spread):
    points = blobs(seed, 400, spread)
    assert run(spark, points, 0.3, 5) == brute_force(points, 0.3, 5)


def test_dense_cells_are_cut_into_smaller_boxes(spark, small_limits):
    points = blobs(3, 300, 0.15)
    assert run(spark, points, 0.5, 5) == brute_force(points, 0.5, 5)


def test_two_dense_groups_just_apart(spark, small_limits):
    # columns of points eps apart or a hair more: boxes alone cannot tell
    rng = random.Random(4)
    for gap in (0.5, 0.5 + 1e-9):
        points = {i: (0.0 if i % 2 else gap, i * 0.001 + rng.choice([0, 0.01])) for i in range(60)}
        assert run(spark, points, 0.5, 3) == brute_force(points, 0.5, 3)


def test_edge_cases(spark):
    chain = {i: (i * 0.5, 0.0) for i in range(40)}
    assert set(run(spark, chain, 0.5, 3).values()) == {0}
    scattered = {i: (i * 10.0, 0.0) for i in range(10)}
    assert set(run(spark, scattered, 0.5, 2).values()) == {-1}
    repeated = {i: (1.0, 1.0) for i in range(6)}
    assert set(run(spark, repeated, 0.5, 5).values()) == {0}
    # point 50 lies between two clusters and goes to the first
    between = {**{i: (0.0, (i - 10) * 0.1) for i in range(10, 16)}, **{i: (0.9, (i - 20) * 0.1) for i in range(20, 26)}, 50: (0.45, 0.0)}
    got = run(spark, between, 0.46, 5)
    assert got == brute_force(between, 0.46, 5) and got[50] == 0


def test_neighbours_in_far_corner_cells(spark):
    side = 0.5 / 2 ** 0.5 * module.SHRINK
    corner = {1: (side - 1e-9, side - 1e-9), 2: (2 * side + 1e-9, 2 * side + 1e-9), 3: (9.0, 9.0)}
    assert brute_force(corner, 0.5, 2) == {1: 0, 2: 0, 3: -1}
    assert run(spark, corner, 0.5, 2) == {1: 0, 2: 0, 3: -1}
    # on a lattice many distances are exactly eps
    lattice = {10 * i + j: (i * 0.3, j * 0.4) for i in range(6) for j in range(6) if (i * j) % 4 != 3}
    assert run(spark, lattice, 0.5, 4) == brute_force(lattice, 0.5, 4)


def test_bad_coordinates_are_an_error(spark):
    with pytest.raises(Exception, match="finite"):
        run(spark, {1: (float("nan"), 0.0)}, 0.5, 2)


def test_components(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rng = random.Random(5)
    ids = rng.sample(range(1000), 200)
    edges = [(a, b) for a, b in zip(ids[:80], ids[1:80])] + [(ids[100], i) for i in ids[101:160]] + [(ids[170], ids[171])]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = spark.createDataFrame([(i,) for i in ids], "node bigint")
    got = components.connected_components(nodes, spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == {i: find(i) for i in ids}
    none = components.connected_components(nodes, spark.createDataFrame([], "u bigint, v bigint"))
    assert none.filter(F.col("node") != F.col("component")).isEmpty() and none.count() == 200
