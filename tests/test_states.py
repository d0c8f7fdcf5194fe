"""Merged states against statistics of all rows at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlore.operators import states
from gridlore.session import new_path


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(
        "id", (F.col("id") % 7).cast("int").alias("periodo"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("categoria"),
        (1e6 + F.pmod(F.xxhash64("id"), F.lit(997)) * F.when(F.col("id") % 3 == 0, 5).otherwise(1)).alias("x"),
        F.when(F.col("id") % 4 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(89)) + F.col("id") / 100).cast("double").alias("y"),
        F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("none")).cache()


def test_merged_moments_are_those_of_all_rows(rows):
    columns = ["x", "y", "flat", "none"]
    kept = states.moment_states(rows, ["periodo", "categoria"], columns)
    got = {r["variable"]: r for r in states.describe_states(kept, digits=12).collect()}
    pdf = rows.toPandas()
    assert set(got) == {"x", "y", "flat"}
    for c in ("x", "y"):
        v = pdf[c].dropna().to_numpy()
        d = v - v.mean()
        assert got[c]["n"] == len(v) and got[c]["minimo"] == round(v.min(), 12) and got[c]["maximo"] == round(v.max(), 12)
        assert math.isclose(got[c]["media"], v.mean(), rel_tol=1e-9) and math.isclose(got[c]["desviacion"], v.std(ddof=1), rel_tol=1e-8)
        assert abs(got[c]["skewness"] - (d**3).mean() / (d**2).mean() ** 1.5) < 1e-4
    assert got["flat"]["skewness"] is None and got["flat"]["desviacion"] == 0
    by = {(r["categoria"], r["variable"]): r["media"] for r in states.describe_states(kept, ["categoria"], 12).collect()}
    assert math.isclose(by["a", "x"], pdf[pdf.categoria == "a"].x.mean(), rel_tol=1e-9)


def test_correlations_use_complete_rows(rows):
    kept = states.moment_states(rows, ["periodo"], ["x", "y", "flat"])
    got = {(r["fila"], r["columna"]): r["valor"] for r in states.correlate_states(kept).collect()}
    pdf = rows.toPandas().dropna(subset=["y"])
    assert len(got) == 9 and abs(got["x", "y"] - np.corrcoef(pdf.x, pdf.y)[0, 1]) < 1e-6 and got["x", "y"] == got["y", "x"]
    assert got["x", "x"] == 1 and got["x", "flat"] is None


def test_sketches_merge_within_the_error(rows):
    kept = states.sketch_states(rows, ["periodo", "categoria"], ["x", "y", "none"])
    answers = states.sketch_quantiles(kept, [0.0, 0.1, 0.5, 0.9, 1.0], ["categoria"])
    found = states.rank_errors(rows, answers, ["categoria"], ["x", "y", "none"]).collect()
    assert len(found) == 2 * 2 * 5 and max(r["error"] for r in found) <= 0.01
    wrong = answers.withColumn("valor", F.col("valor") + 2000)
    assert states.rank_errors(rows, wrong, ["categoria"], ["x", "y", "none"]).agg(F.max("error")).first()[0] > 0.05


def test_refresh_reads_touched_partitions_only(spark, rows):
    stored, kept = new_path(spark, "rows"), new_path(spark, "states")
    build = lambda df: states.moment_states(df, ["periodo"], ["x"])
    rows.write.partitionBy("periodo").parquet(stored)
    states.refresh_states(spark, stored, kept, ["periodo"], build)
    before = {r["periodo"]: r["n"] for r in spark.read.parquet(kept).collect()}
    rows.filter("periodo = 2").withColumn("x", F.lit(0.0)).union(rows.filter("periodo = 2")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("periodo").parquet(stored)
    rows.filter("periodo = 3").limit(0).write.mode("append").partitionBy("periodo").parquet(stored)
    seen = []

    def noting(df):
        seen.append({r["periodo"] for r in df.select("periodo").distinct().collect()})
        return build(df)

    for _ in range(2):
        states.refresh_states(spark, stored, kept, ["periodo"], noting, rows.filter("periodo = 2"))
    after = {r["periodo"]: r["n"] for r in spark.read.parquet(kept).collect()}
    assert seen == [{2}, {2}] and after == before | {2: 2 * before[2]}


def test_no_rows(rows):
    none = rows.limit(0)
    assert states.describe_states(states.moment_states(none, ["periodo"], ["x"])).count() == 0
    assert states.sketch_quantiles(states.sketch_states(none, ["periodo"], ["x"]), [0.5]).count() == 0
