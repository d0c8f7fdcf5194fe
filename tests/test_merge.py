import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.functions.numbers import currency_to_double
from gridlore.operators import merge
from gridlore.session import new_path
from gridlore.streaming import incremental


def table(spark, rows, ddl="id string, p string, v double"):
    return spark.createDataFrame(rows, ddl)


def test_upsert_states_and_nulls(spark, rows):
    target = table(spark, [("a", "x", 1.0, "t"), ("b", "x", 2.0, "t"), ("c", "x", 3.0, "t")], "id string, p string, v double, only string")
    source = table(spark, [("b", "x", None, 9), ("c", "x", 3.0, 9), ("d", "x", 4.0, 9)], "id string, p string, v double, extra int")
    merged = merge.upsert(target, source, "id")
    assert [(r["id"], r["v"], r["only"], r["extra"]) for r in merged.orderBy("id").collect()] == [
        ("a", 1.0, "t", None), ("b", None, "t", 9), ("c", 3.0, "t", 9), ("d", 4.0, None, 9)]
    # a column new to the table changes every matched row
    assert tuple(merge.upsert_counters(merged).first()) == (1, 2, 2)
    same = merge.upsert(target, source.drop("extra"), "id")
    assert tuple(merge.upsert_counters(same).first()) == (1, 1, 2)


def test_upsert_table_twice(spark, rows):
    path = new_path(spark, "t")
    source = table(spark, [("a", "x", 1.0), ("b", "y", 2.0), ("c", None, 3.0)])
    assert tuple(merge.upsert_table(path, source, "id", ["p"]).first()) == (3, 0, 0)
    before = rows(spark.read.parquet(path).select("id", "p", "v"))
    assert tuple(merge.upsert_table(path, source, "id", ["p"]).first()) == (0, 0, 3)
    assert rows(spark.read.parquet(path).select("id", "p", "v")) == before
    change = table(spark, [("b", "y", 5.0), ("b", "y", 4.0), ("e", "y", 6.0)])
    assert tuple(merge.upsert_table(path, change, "id", ["p"]).first()) == (1, 1, 1)
    assert rows(spark.read.parquet(path).select("id", "v")) == [("a", 1.0), ("b", 5.0), ("c", 3.0), ("e", 6.0)]


def test_latest_by(spark, rows):
    df = table(spark, [("a", "1", 1.0), ("a", "2", 0.5), ("a", "2", 0.7), ("b", None, None)])
    assert rows(merge.latest_by(df, ["id"], ["p", "v"])) == [("a", "2", 0.7), ("b", None, None)]


def test_replace(spark, rows):
    target = table(spark, [("a", "x", 1.0), ("b", None, 2.0), ("c", "y", 3.0)])
    source = table(spark, [("n", "x", 9.0)])
    assert rows(merge.replace_where(target, source, F.col("p") == "x")) == [("b", None, 2.0), ("c", "y", 3.0), ("n", "x", 9.0)]
    assert rows(merge.replace_keys(target, source, ["p"])) == [("b", None, 2.0), ("c", "y", 3.0), ("n", "x", 9.0)]
    assert tuple(merge.replace_counters(target, source, F.col("p") == "x").first()) == (1, 1)
    # deletes even when nothing arrives
    assert rows(merge.replace_where(target, source.filter("false"), F.col("p") == "x")) == [("b", None, 2.0), ("c", "y", 3.0)]


def test_append_with_quarantine(spark, rows):
    df = spark.createDataFrame([("a", "£1.50"), ("b", "x"), ("c", None)], "id string, valor string")
    good, bad = new_path(spark, "good"), new_path(spark, "bad")
    for n in (1, 2):
        counts = merge.append_with_quarantine(df, "valor", currency_to_double("valor"), good, bad)
        assert tuple(counts.first()) == (1, 2)
        assert spark.read.parquet(good).count() == n
    assert rows(spark.read.parquet(bad).distinct()) == [("b", "x"), ("c", None)]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("value", T.DoubleType())])


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch_in_any_order(spark, rows, files):
    sent = spark.range(300).selectExpr(
        "id % 100 AS id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id * 37) % 300) AS ts",
        "CAST(id AS double) AS value")
    landing, stored, state = (new_path(spark, n) for n in ("landing", "stored", "state"))
    sent.repartition(6).write.parquet(landing)
    stream = incremental.read_files(spark, landing, SCHEMA, files_per_batch=files)
    incremental.run_upsert(stream, stored, ["id"], ["ts"], state)
    expected = rows(merge.latest_by(sent, ["id"], ["ts"]))
    assert rows(incremental.current_rows(spark, stored, SCHEMA, ["id"], ["ts"])) == expected
    # nothing new: the second run changes nothing; a late old row changes nothing either
    sent.selectExpr("id", "ts - INTERVAL 1 DAY AS ts", "-1.0 AS value").write.mode("append").parquet(landing)
    incremental.run_upsert(incremental.read_files(spark, landing, SCHEMA), stored, ["id"], ["ts"], state)
    assert rows(incremental.current_rows(spark, stored, SCHEMA, ["id"], ["ts"])) == expected
    packed = new_path(spark, "packed")
    incremental.compact(spark, stored, SCHEMA, ["id"], ["ts"], packed)
    assert rows(incremental.current_rows(spark, packed, SCHEMA, ["id"], ["ts"])) == expected
