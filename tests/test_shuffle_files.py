"""Shuffle files of written tables do not stay on disk."""

import os
import time

from pyspark.sql import functions as F

from gridlore.operators import merge
from gridlore.session import CLEANUP_KEY, materialize, new_path


def _shuffled(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.join(d, x) for top in dirs for d, _, names in os.walk(top) for x in names if x.startswith("shuffle_") and x.endswith(".data")}


def _left(spark, before):
    """Shuffle files that are new; they go soon after the execution."""
    until = time.time() + 20
    while (left := _shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_written_tables_leave_no_shuffle_files(spark, rows):
    df = spark.range(2000).select((F.col("id") % 500).cast("string").alias("id"), (F.col("id") % 3).alias("p"), F.rand(1).alias("v"))
    before = _shuffled(spark)
    latest = materialize(merge.latest_by(df, ["id", "p"], ["v"]), "latest")
    assert not _left(spark, before) and latest.count() == 1500
    before = _shuffled(spark)
    path = new_path(spark, "parts")
    merge.replace_partitions(latest, path, ["p"])
    assert not _left(spark, before)
    assert rows(spark.read.parquet(path).select("id", "p", "v")) == rows(latest)
    assert spark.conf.get(CLEANUP_KEY, "false") == "false"
