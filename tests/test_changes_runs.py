"""The feed's work is joins and aggregates, and a batch run again writes what it wrote."""

import os

from gridlore.session import new_path
from gridlore.streaming import changes, incremental

SCHEMA = "id int, ts long, value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def test_no_row_passes_through_python(spark):
    rows = spark.range(4).selectExpr("CAST(id AS INT) AS id", "id AS ts", "0.5D AS value")
    feed = changes.Feed(rows, ["id"], ["ts"])
    moves = changes._moves(rows, rows.selectExpr("*", "1L AS _version"), feed)
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "TransformWithState" not in plan
    assert moves.count() == 0


def test_a_batch_run_again_gives_the_same_feed(spark, rows):
    landing, feed, state = (new_path(spark, n) for n in ("landing", "feed", "feed-state"))

    def run():
        changes.run_changes(changes.change_feed(incremental.read_files(spark, landing, frame(spark, []).schema), ["id"], ["ts"]), feed, state)

    for part in ([(1, 1, 1.0), (2, 1, 1.0)], [(1, 2, 5.0), (2, 2, 1.0), (None, 1, None)]):
        frame(spark, part).write.mode("append").parquet(landing)
        run()
    want = [(1, 1, "alta", 1.0), (1, 2, "cambio", 5.0), (2, 1, "alta", 1.0), (None, 1, "alta", None)]

    def found():
        return sorted((tuple(r) for r in spark.read.parquet(feed).select("id", "_version", "_tipo", "value").collect()), key=str)

    assert found() == sorted(want, key=str)
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(state, "commits", name))  # as if it had died before its commit
    run()
    assert found() == sorted(want, key=str)
    assert rows(changes.replay(spark, feed, ["id"])) == [(1, 2, 5.0), (2, 1, 1.0), (None, 1, None)]
