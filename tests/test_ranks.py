import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlore.operators import ranks, sampling, skew, stats


@pytest.fixture
def many_buckets(monkeypatch):
    """Small buckets and a low bar for hot keys, so that small data takes the paths of large data."""
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(ranks, "MIN_PROBES", 200)
    monkeypatch.setattr(ranks, "PROBES_PER_BUCKET", 2)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    monkeypatch.setattr(skew, "FANOUT", 4)


def sample(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), 7.0 if i % 3 == 0 else rng.choice([rng.gauss(0, 100), None, float(rng.randint(0, 9))]))
            for i in range(900)]
    return spark.createDataFrame(rows, "id int, g string, v double")


@pytest.mark.parametrize("by", [[], ["g"]])
def test_percent_rank_equals_window(spark, many_buckets, rows, by):
    df = sample(spark)
    window = Window.partitionBy(*by).orderBy("v") if by else Window.orderBy("v")
    expected = df.withColumn("pr", F.round(F.percent_rank().over(window), 9))
    got = ranks.percent_rank(df, "v", "pr", by).withColumn("pr", F.round("pr", 9))
    assert rows(got) == rows(expected)


def test_percent_rank_one_row_and_nan(spark, rows):
    one = spark.createDataFrame([(1, 5.0)], "id int, v double")
    assert rows(ranks.percent_rank(one, "v", "pr")) == [(1, 5.0, 0.0)]
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, 2.0)], "id int, v double")
    assert {r["id"]: r["pr"] for r in ranks.percent_rank(df, "v", "pr").collect()} == {2: 0.0, 3: 0.5, 1: 1.0}


def test_quantiles(spark, many_buckets):
    values = [v for (v,) in sample(spark).select("v").na.drop().collect()]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    disc = ranks.exact_quantiles_wide(df, "v", {"q": 0.25, "m": 0.5, "t": 1.0}).first()
    ordered = sorted(values)
    n = len(ordered)
    assert disc["q"] == ordered[-(-n // 4) - 1] and disc["t"] == ordered[-1]
    cont = ranks.exact_quantiles_wide(df, "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, interpolate=True).first()
    assert tuple(cont) == pytest.approx(statistics.quantiles(values, n=4, method="inclusive"))


def test_quantiles_grouped_and_empty(spark, many_buckets):
    df = sample(spark)
    got = {r["g"]: r["m"] for r in ranks.exact_quantiles_wide(df, "v", {"m": 0.5}, ["g"], True).collect()}
    expected = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got == pytest.approx(expected)
    assert ranks.exact_quantiles_wide(df.filter("false"), "v", {"m": 0.5}).first()["m"] is None
    assert ranks.exact_quantiles_wide(df.filter("false"), "v", {"m": 0.5}, ["g"]).isEmpty()


def test_positions(spark, many_buckets):
    ids = random.Random(2).sample(range(10**6), 300)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r["id"]: r["p"] for r in ranks.positions(df, "id", "p").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_split_join_is_a_plain_join(spark, many_buckets, rows):
    many = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    few = spark.range(0, 1000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")).unionByName(
        spark.createDataFrame([(1, 5)], "k bigint, y bigint"))
    hot = skew.hot_keys(many.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", 1000)
    assert [r["k"] for r in hot.collect()] == [1]
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(skew.split_join(many, few, ["k"], hot, ["x"], how)) == rows(many.join(few, "k", how))


def test_spearman_ties_and_incomplete_rows(spark, rows):
    df = spark.createDataFrame([(1, 1.0, 1.0, "x"), (2, 1.0, 2.0, "x"), (3, 2.0, 3.0, "x"), (4, 9.0, 4.0, "x"), (5, 3.0, 9.0, None)],
                               "id int, a double, b double, note string")
    got = {(r["fila"], r["columna"]): r["valor"] for r in stats.rank_correlation(df, ["a", "b"], ["id"]).collect()}
    plain = df
    for c in ("a", "b"):
        plain = plain.withColumn(c, F.percent_rank().over(Window.orderBy(c)))
    expected = plain.na.drop().agg(F.round(F.corr("a", "b"), 6)).first()[0]
    assert got["a", "b"] == got["b", "a"] == expected and got["a", "a"] == 1.0


def test_sample_and_split_do_not_depend_on_layout(spark, rows):
    df = spark.range(1000)
    assert rows(sampling.sample_n(df, ["id"], 10, 7)) == rows(sampling.sample_n(df.repartition(7), ["id"], 10, 7))
    train, test = sampling.train_test_split(df, ["id"])
    again, _ = sampling.train_test_split(df.repartition(5), ["id"])
    assert train.count() + test.count() == 1000 and 640 < train.count() < 760
    assert rows(train) == rows(again) and train.join(test, "id").isEmpty()
