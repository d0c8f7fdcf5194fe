"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Removes the shuffle files of an execution when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_fallback: list[str] = []


def build_session(app: str = "gridlore", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on; master and partition counts stay the cluster's unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        # local mode runs everything in the driver JVM
        builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that
    folder would exist on one machine alone.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder shared by the cluster")
    if not _local_fallback:
        _local_fallback.append(tempfile.mkdtemp(prefix="gridlore-"))
    return _local_fallback[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/gridlore/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes started in here leave no shuffle files; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives later stages
    column pruning and true size statistics. The shuffle files of the write go when it ends.
    """
    path = new_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deals a scan of fewer splits than cores out over all cores; a scan of many splits is left as it is.

    A file of one row group is read by one task, and everything up to the next shuffle would stay there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
