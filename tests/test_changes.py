"""The feed of changed rows, over several runs of one stream."""

import datetime as dt

import pytest

from gridlore.session import new_path
from gridlore.streaming import changes, incremental

SCHEMA = "id int, zone string, ts timestamp, value double, note string"


def at(day):
    return dt.datetime(2024, 1, day)


@pytest.fixture
def run(spark):
    landing, feed, state = (new_path(spark, n) for n in ("landing", "feed", "feed-state"))

    def send(rows, files_per_batch=None):
        """The feed after the rows; each list is one file and, with a limit of one, one batch."""
        for part in rows:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream = incremental.read_files(spark, landing, spark.createDataFrame([], SCHEMA).schema, files_per_batch=files_per_batch)
        changes.run_changes(changes.change_feed(stream, ["id", "zone"], ["ts"]), feed, state)
        return feed

    return send


def feed_rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "_version", "_tipo", "value", "note").collect())


def test_only_changes_are_written(spark, run, rows):
    first = [(1, "a", at(2), 1.0, "x"), (1, "a", at(1), 9.0, "late"), (2, "a", at(1), None, None), (3, None, at(1), float("nan"), "n")]
    path = run([first])
    assert rows(spark.read.parquet(path).select("id", "zone", "ts", "_version", "_tipo", "note")) == rows(spark.createDataFrame(
        [(1, "a", at(2), 1, "alta", "x"), (2, "a", at(1), 1, "alta", None), (3, None, at(1), 1, "alta", "n")],
        "id int, zone string, ts timestamp, _version long, _tipo string, note string"))
    size = spark.read.parquet(path).count()
    run([first])  # the same again
    assert spark.read.parquet(path).count() == size
    # newer with the same values, older with others, newer with others, an equal moment with a greater rest
    run([[(1, "a", at(3), 1.0, "x"), (2, "a", at(2), 5.0, None), (3, None, at(1), float("nan"), "o")]])
    run([[(1, "a", at(2), 7.0, "older than the state")]])
    assert [r for r in feed_rows(spark, path) if r[1] > 1 and r[0] != 3] == [(2, 2, "cambio", 5.0, None)]
    assert [(r[0], r[4]) for r in feed_rows(spark, path) if r[1] == 2 and r[0] == 3] == [(3, "o")]
    run([])
    assert spark.read.parquet(path).count() == size + 2


def test_replay_equals_the_newest_rows(spark, run, rows):
    sent = [[(i % 7, "abc"[i % 3], at(1 + (i * 5 + b) % 28), float(i % 4), f"n{(i + b) % 2}") for i in range(40)] for b in range(4)]
    path = run(sent, files_per_batch=1)
    every = spark.createDataFrame([r for part in sent for r in part], SCHEMA)
    ours = changes.replay(spark, path, ["id", "zone"]).select("id", "zone", "value", "note")
    assert rows(ours) == rows(changes.latest_by(every, ["id", "zone"], ["ts"]).select("id", "zone", "value", "note"))


def test_clashing_columns_are_refused(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("value", "_Version")
    with pytest.raises(ValueError, match="_version"):
        changes.change_feed(stream, ["timestamp"], [])
