"""Statistics of columns without spread."""

import math

import pytest

from gridlore.operators import stats


def cells(df):
    return {(r["fila"], r["columna"]): r["valor"] for r in df.collect()}


def test_correlation_of_a_constant_column_is_nan(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 3.0, 4.0), (1.0, 5.0, 2.0)], "a double, b double, c double")
    got = cells(stats.correlation(frame, ["a", "b", "c"]))
    assert got["b", "c"] == got["c", "b"] == -1.0 and got["b", "b"] == 1.0
    assert all(math.isnan(v) for k, v in got.items() if "a" in k) and len(got) == 9
    assert set(cells(stats.correlation(frame.limit(0), ["a", "b"])).values()) == {None}


@pytest.mark.parametrize("rows", [1, 4])
def test_rank_correlation_of_a_constant_column_is_nan(spark, rows):
    frame = spark.createDataFrame([(i, 7.0, float(i * i)) for i in range(rows)], "i int, a double, b double")
    got = cells(stats.rank_correlation(frame, ["a", "b"], ["i"]))
    assert math.isnan(got["a", "b"]) and math.isnan(got["a", "a"])
    assert got["b", "b"] == 1.0 if rows > 1 else math.isnan(got["b", "b"])
