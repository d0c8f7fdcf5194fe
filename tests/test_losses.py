"""Rows and columns that must survive merges, readers and reports."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.functions.numbers import currency_to_double, parse_int
from gridlore.operators import merge, stats
from gridlore.session import new_path
from gridlore.sources.files import read_csv_with_banner


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_upsert_keeps_null_key(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    source = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    merged = merge.upsert(target, source, "k")
    assert rows(merged, "k", "v", merge.STATE) == sorted(
        [("a", 1, "untouched"), (None, 3, "modified"), ("b", 4, "inserted")], key=str)
    new = merge.upsert(target.filter("k = 'a'"), source, "k")
    assert rows(new.filter("k is null"), "v", merge.STATE) == [(3, "inserted")]


def test_upsert_table_keeps_columns_of_the_table(spark):
    path = new_path(spark, "wide")
    merge.upsert_table(path, spark.createDataFrame([("a", "p", 1, "x"), ("b", "p", 1, "y")], "k string, g string, v int, extra string"), "k", ["g"])
    merge.upsert_table(path, spark.createDataFrame([("a", "p", 2)], "k string, g string, v int"), "k", ["g"])
    assert rows(spark.read.parquet(path), "k", "v", "extra") == [("a", 2, "x"), ("b", 1, "y")]


def test_replace_null_key_and_counters(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2)], "g string, v int")
    source = spark.createDataFrame([(None, 5)], "g string, v int")
    assert rows(merge.replace_keys(target, source, ["g"]), "g", "v") == sorted([("a", 2), (None, 5)], key=str)
    path = new_path(spark, "replace")
    assert tuple(merge.replace_table(path, target, ["g"], ["g"]).first()) == (0, 2)
    assert tuple(merge.replace_table(path, source, ["g"], ["g"]).first()) == (1, 1)
    assert tuple(merge.replace_table(path, source, ["g"], ["g"]).first()) == (1, 1)
    assert rows(spark.read.parquet(path), "v") == [(2,), (5,)]
    with pytest.raises(ValueError, match="v"):
        merge.replace_table(path, source, ["g"], ["v"])


def test_banner_goes_by_place(spark, tmp_path):
    two = tmp_path / "two.csv"
    two.write_text("Projects 2024,\nname,power\nA,1\nB,\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("power", T.IntegerType())])
    assert rows(read_csv_with_banner(spark, str(two), schema), "name", "power") == [("A", 1), ("B", None)]
    one = tmp_path / "one.csv"
    one.write_text("Projects 2024\nname\nA\nB\n")
    assert rows(read_csv_with_banner(spark, str(one), T.StructType([schema[0]])), "name") == [("A",), ("B",)]


def test_numbers_have_no_java_suffix(spark):
    df = spark.createDataFrame([("2024",), ("2024d",), ("2024F",), ("2024.7",), ("0x1p3",)], "s string")
    assert [r[0] for r in df.select(parse_int("s")).collect()] == [2024, None, None, 2024, None]
    assert [r[0] for r in df.select(currency_to_double("s")).collect()] == [2024.0, None, None, 2024.7, None]
    assert spark.range(1).select(parse_int(F.lit(True))).first()[0] is None


def test_reports_keep_null_groups_and_unlisted_classes(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert {r["g"] for r in stats.boxplot(df, "g", "v").collect()} == {None, "a"}
    with pytest.raises(ValueError, match="g"):
        stats.confusion(df, "v", "g", ["a"])
