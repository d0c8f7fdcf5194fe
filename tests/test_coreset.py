"""Weighted samples for K-means against all rows."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from gridlore.operators import coreset


def points(spark, xs):
    return spark.createDataFrame([(i, Vectors.dense(x)) for i, x in enumerate(xs)], ["id", "scaledFeatures"])


def test_weights_stand_for_all_rows(spark):
    rng = np.random.default_rng(1)
    xs = np.concatenate([rng.normal(c, 1.0, (1500, 3)) for c in (-8.0, 0.0, 9.0)] + [np.full((1, 3), 400.0)])
    rows = points(spark, xs.tolist())
    core = coreset.coreset(rows, ["id"], 500)
    found = core.collect()
    assert 380 <= len(found) <= 620
    assert any(r["scaledFeatures"][0] == 400.0 for r in found)  # the far row is never missed
    assert sum(r["peso"] for r in found) == pytest.approx(len(xs), rel=0.2)
    again = coreset.coreset(rows.repartition(7), ["id"], 500)
    assert {r["id"] for r in again.collect()} == {r["id"] for r in found}
    (_, cost, shape, model), = coreset.sweep(rows, ["id"], [4], 500)
    full = KMeans(k=4, seed=42, featuresCol="scaledFeatures").fit(rows)
    assert coreset.costs(rows, [full])[0] == pytest.approx(full.summary.trainingCost, rel=1e-9)
    near = ((xs[:, None] - np.array(model.clusterCenters())[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert cost == pytest.approx(near, rel=1e-9)
    assert cost <= 1.2 * full.summary.trainingCost and shape > 0.5


def test_equal_rows_and_no_rows(spark):
    same = points(spark, [[1.0, 2.0]] * 10)
    assert [r["peso"] for r in coreset.coreset(same, ["id"], 100).collect()] == [1.0] * 10
    assert coreset.coreset(same.limit(0), ["id"], 100).isEmpty()
