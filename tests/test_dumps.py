"""Document dumps in extended JSON: wrappers of both versions, damaged lines, pushed filters, round trips."""

import datetime as dt
import decimal

import pytest

from gridlore.session import new_path
from gridlore.sources.dumps import read_dump, write_dump

SCHEMA = ("_id string, kind string, n long, x double, price decimal(10,2), at timestamp, day date, ok boolean, "
          "raw binary, place struct<city: string, n: int>, tags array<string>, counts array<long>")
LINES = [
    '{"_id": {"$oid": "5f1"}, "kind": "a", "n": {"$numberLong": "9007199254740993"}, "x": {"$numberDouble": "NaN"}, '
    '"price": {"$numberDecimal": "12.50"}, "at": {"$date": {"$numberLong": "1500"}}, "day": {"$date": "2020-02-03T00:00:00Z"}, "ok": true, '
    '"raw": {"$binary": {"base64": "aGk=", "subType": "00"}}, "place": {"city": "P", "n": {"$numberInt": "3"}, "more": 1}, '
    '"tags": ["t", "u,v"], "counts": [{"$numberLong": "1"}, 2]}',
    '{"_id": 7, "kind": "b", "n": 5, "x": 1.5, "at": {"$date": 2500}, "day": null, "ok": "no", "raw": {"$binary": "aGk=", "$type": "00"}, "tags": []}',
    "not a document",
    '{"_id": {"$oid": "5f2"}, "kind": {"$undefined": true}, "n": "many", "other": 1}',
    "{}",
]


@pytest.fixture(scope="module")
def dump(spark):
    path = new_path(spark, "dump")
    spark.createDataFrame([(line,) for line in LINES], "value string").coalesce(1).write.text(path)
    return path


def test_wrappers_come_off(spark, dump):
    rows = {r["_id"]: r for r in read_dump(spark, dump, SCHEMA).collect()}
    assert set(rows) == {"5f1", "7", "5f2", None}
    one, two, three = rows["5f1"], rows["7"], rows["5f2"]
    assert (one["n"], one["price"], one["ok"], bytes(one["raw"])) == (9007199254740993, decimal.Decimal("12.50"), True, b"hi")
    assert one["x"] != one["x"] and one["day"] == dt.date(2020, 2, 3)
    assert one["at"] == dt.datetime(1970, 1, 1, 0, 0, 1, 500_000) and two["at"].second == 2
    assert (one["place"]["city"], one["place"]["n"], one["tags"], one["counts"]) == ("P", 3, ["t", "u,v"], [1, 2])
    assert (two["n"], two["x"], two["day"], bytes(two["raw"]), two["tags"], two["place"]) == (5, 1.5, None, b"hi", [], None)
    assert (three["kind"], three["n"], three["x"]) == (None, None, None)


def test_damaged_lines(spark, dump):
    assert [r["line"] for r in read_dump(spark, dump, SCHEMA, damaged=True).collect()] == ["not a document"]


def test_filter_reaches_the_scan(spark, dump):
    found = read_dump(spark, dump, "_id string, kind string", only={"kind": "b"})
    assert [r["_id"] for r in found.collect()] == ["7"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,b)" in plan and "ReadSchema: struct<_id:string,kind:string>" in plan
    with pytest.raises(ValueError):
        read_dump(spark, dump, "n long", only={"n": "5"})


def test_a_large_file_is_split(spark):
    path = new_path(spark, "large-dump")
    write_dump(spark.range(20_000).selectExpr("id", "repeat('x', 50) AS text").coalesce(1), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = read_dump(spark, path, "id long, text string")
        assert found.rdd.getNumPartitions() > 4
        assert found.selectExpr("count(*)", "count(DISTINCT id)", "sum(id)").first()[:] == (20_000, 20_000, 199_990_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_round_trip_and_empty(spark):
    rows = [("5f", 1, 2.5, decimal.Decimal("3.10"), dt.datetime(2020, 1, 2, 3, 4, 5, 6000), dt.date(1960, 5, 6), b"\x00\xff", ("c", 2), ["a"], True),
            (None,) * 10]
    schema = ("_id string, n long, x double, p decimal(6,2), at timestamp, day date, raw binary, s struct<c: string, m: long>, l array<string>, ok boolean")
    df = spark.createDataFrame(rows, schema)
    for part in (df, df.limit(0)):
        path = new_path(spark, "dump")
        write_dump(part, path, object_ids=["_id"])
        assert sorted(map(str, read_dump(spark, path, schema).collect())) == sorted(map(str, part.collect()))
