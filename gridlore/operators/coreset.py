"""K-means for many numbers of clusters over a weighted sample that stands for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.operators.modeling import SEED
from gridlore.session import materialize

WEIGHT = "peso"
#: Rows a sample has in expectation.
SIZE = 5_000


def squared_distance(point: Column, centre: Sequence[float]) -> Column:
    parts = F.zip_with(point, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


def coreset(rows: DataFrame, keys: Sequence[str], size: int = SIZE, features: str = "scaledFeatures", seed: int = SEED) -> DataFrame:
    """About ``size`` of ``rows``, with ``peso``: the number of rows each stands for.

    A row's chance is half even, half its share of all squared distances from the mean, so far rows are not missed and the weighted cost of
    any centres is, in expectation, that of all rows. Draws hash ``keys``: they do not depend on partitions. With ``size`` rows or fewer
    all are likely to stay; null vectors take no part.
    """
    known = rows.filter(F.col(features).isNotNull())
    if known.isEmpty():  # there is no mean
        return known.withColumn(WEIGHT, F.lit(1.0))
    whole = known.agg(F.count("*").alias("n"), Summarizer.mean(F.col(features)).alias("mean")).first()
    far = squared_distance(vector_to_array(features), whole["mean"])
    total = known.agg(F.sum(far)).first()[0]
    share = far / total if total else F.lit(1.0 / whole["n"])
    chance = F.least(F.lit(1.0), size * (0.5 / whole["n"] + 0.5 * share))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))
    return known.withColumn(WEIGHT, 1.0 / chance).filter(draw < chance)


def costs(rows: DataFrame, models: Sequence[KMeansModel], features: str = "scaledFeatures") -> list[float]:
    """Summed squared distances of all rows to their nearest centres under each model, in one pass."""
    point = vector_to_array(features)
    nearest = [F.sum(F.array_min(F.array(*[squared_distance(point, c) for c in m.clusterCenters()]))) for m in models]
    found = rows.filter(F.col(features).isNotNull()).agg(*[c.alias(f"c{i}") for i, c in enumerate(nearest)]).first()
    return [float(c or 0.0) for c in found]


def sweep(rows: DataFrame, keys: Sequence[str], ks: Sequence[int], size: int = SIZE, features: str = "scaledFeatures",
          ) -> list[tuple[int, float, float, KMeansModel]]:
    """``k``, cost over all rows, silhouette over the sample and model for each of ``ks``: all fits run on the sample.

    All rows are read three times, whatever the number of fits: mean, distances with draws, costs.
    """
    core = materialize(coreset(rows, keys, size, features), "coreset")
    judge = ClusteringEvaluator(featuresCol=features, metricName="silhouette", weightCol=WEIGHT)
    models = [KMeans(k=k, seed=SEED, featuresCol=features, weightCol=WEIGHT).fit(core) for k in ks]
    shapes = [float(judge.evaluate(m.transform(core))) for m in models]
    return list(zip(ks, costs(rows, models, features), shapes, models))
