"""The idempotent reload as an incremental job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridlore.operators.merge import latest_by

BATCH = "_batch"


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_upsert(stream: DataFrame, table: str, keys: Sequence[str], newest: Sequence[str],
               checkpoint: str) -> None:
    """Works off all waiting files into ``table`` and ends.

    Each batch is reduced to its newest row per key and stored under its batch number. A batch repeated after a
    failure replaces its own folder, and the newest row wins when the table is read, so neither repeats nor the
    order of batches change the result, and a batch costs its own size, not the table's. There is no watermark:
    a late row is only older, not wrong. ``checkpoint`` belongs to the table: with another one batch numbers would start
    again and replace stored batches.
    """
    def store(batch: DataFrame, number: int) -> None:
        latest_by(batch, keys, newest).write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")

    query = (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current_rows(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str],
                 newest: Sequence[str]) -> DataFrame:
    """The table as of now: the newest row of each key over all batches."""
    return latest_by(spark.read.schema(schema).parquet(f"{table}/{BATCH}=*"), keys, newest)


def compact(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], newest: Sequence[str],
            into: str) -> None:
    """Writes the current rows as the first batch of a new table."""
    current_rows(spark, table, schema, keys, newest).write.parquet(f"{into}/{BATCH}=-1")
