"""Writes that tally their rows as they go, and appends that a rerun replaces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BATCH, STATE, RAW = "lote", "estado", "valor_crudo"
LOADED, HELD = "cargado", "cuarentena"


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **tallies: Column) -> dict[str, int]:
    """Runs ``write`` on ``df`` and returns the tallies its tasks made on the way: no second pass over the rows."""
    seen = Observation()
    write(df.observe(seen, *[column.alias(name) for name, column in tallies.items()]))
    return dict(seen.get)


def append_batch(df: DataFrame, column: str, converted: Column, path: str, batch: str) -> dict[str, int]:
    """Appends one batch to the table at ``path`` and returns ``exitosos`` and ``fallidos``.

    Rows whose value converts are ``cargado``; the others are ``cuarentena``, with null in ``column`` and the value as it came in
    ``valor_crudo``. The batch is one partition, replaced as a whole when its write commits: running a batch again
    does not double it, other batches are not touched, and a write that dies before its commit leaves what was there. One pass.
    """
    state = F.when(F.col("_converted").isNotNull(), LOADED).otherwise(HELD)
    raw = F.when(F.col("_converted").isNull(), F.col(column).cast("string"))
    rows = df.withColumn("_converted", converted).withColumns({RAW: raw, STATE: state, BATCH: F.lit(batch)})
    rows = rows.withColumn(column, F.col("_converted")).drop("_converted")

    def write(out: DataFrame) -> None:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)

    counts = observed_write(rows, write, exitosos=F.count_if(F.col(STATE) == LOADED), fallidos=F.count_if(F.col(STATE) == HELD))
    if not sum(counts.values()):  # a batch without rows names no partition to replace
        rows.drop(BATCH).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")
    return counts


def batch_rows(spark: SparkSession, path: str, state: str) -> DataFrame:
    """The table's rows of a state, as they were given."""
    rows = spark.read.parquet(path).filter(F.col(STATE) == state)
    return rows.drop(STATE, RAW) if state == LOADED else rows.drop(STATE)
