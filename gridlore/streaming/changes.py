"""A feed of changed rows: the newest row of every key is stored, and only what changes it is written on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.operators.merge import latest_by
from gridlore.streaming.incremental import BATCH

KIND, VERSION = "_tipo", "_version"
#: Kinds of change: a key's first row, and a newer one with other values.
NEW, CHANGED = "alta", "cambio"


@dataclass(frozen=True)
class Feed:
    """A stream with the columns that make its keys and those that tell its newest rows."""

    stream: DataFrame
    keys: list[str]
    newest: list[str]


def change_feed(stream: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> Feed:
    """The rows of ``stream`` that change their key's newest row, with ``_tipo`` and ``_version`` (from 1 for each key).

    Of a batch each key gives at most one row, its newest: the one with the greatest ``newest`` columns, then the greatest rest. Repeats,
    late rows and rows that are newer without other values give none. Null and NaN are values like others. Batches are reduced
    by aggregates, so a hot key is no burden.
    """
    clash = [c for c in (KIND, VERSION, BATCH) if c.lower() in {x.lower() for x in stream.columns}]
    if clash:
        raise ValueError(f"the feed adds {clash}: rename these columns of the stream")
    return Feed(stream, list(keys), list(newest))


def _moves(latest: DataFrame, held: DataFrame, feed: Feed) -> DataFrame:
    """Rows of ``latest`` that are newer than the ``held`` row of their key, with its next version; ``_tipo`` is null where only the order moved."""
    rest = [c for c in latest.columns if c not in feed.keys and c not in feed.newest]

    def same(a: str, b: str) -> Column:
        on = F.lit(True)
        for c in feed.keys:
            on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        return on

    def order(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in [*feed.newest, *rest]])

    # only what the batch touches is shuffled; a small batch is broadcast
    touched = held.alias("h").join(latest.select(*feed.keys).alias("k"), same("h", "k"), "left_semi")
    before = latest_by(touched, feed.keys, feed.newest)
    met = latest.alias("n").join(before.alias("h"), same("n", "h"), "left")
    first = F.col(f"h.{VERSION}").isNull()
    told = F.lit(False)
    for c in rest:
        told = told | ~F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}"))
    kind = F.when(first, NEW).when(told, CHANGED)
    version = F.when(first, F.lit(1)).when(told, F.col(f"h.{VERSION}") + 1).otherwise(F.col(f"h.{VERSION}")).cast("long")
    return met.filter(first | (order("n") > order("h"))).select(*[F.col(f"n.{c}").alias(c) for c in latest.columns], kind.alias(KIND), version.alias(VERSION))


def run_changes(feed: Feed, path: str, checkpoint: str) -> None:
    """Works off all waiting files and writes their changes to ``path``, each once, then ends.

    A batch is one partition there and one of the state beside the ``checkpoint``, which holds all rows that were once newest. It is compared
    with the state of earlier batches only, so a batch repeated after a failure writes the same rows in its own place. It reads the
    keys of the state and shuffles its own rows and those of the state that have its keys. All work is joins and aggregates.
    """
    spark = feed.stream.sparkSession
    moves, arrived = f"{checkpoint}/newest", f"{checkpoint}/arrived"

    def work(batch: DataFrame, number: int) -> None:
        latest_by(batch, feed.keys, feed.newest).write.mode("overwrite").parquet(arrived)
        latest = spark.read.schema(feed.stream.schema).parquet(arrived)
        state = latest.withColumn(VERSION, F.lit(None).cast("long")).schema
        held = spark.createDataFrame([], state) if number == 0 else spark.read.schema(state).parquet(
            *[f"{moves}/{BATCH}={n}" for n in range(number)])
        _moves(latest, held, feed).write.mode("overwrite").parquet(f"{moves}/{BATCH}={number}")
        moved = spark.read.schema(state.add(KIND, "string")).parquet(f"{moves}/{BATCH}={number}")
        moved.filter(F.col(KIND).isNotNull()).select(*latest.columns, KIND, VERSION).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    query = (feed.stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def replay(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table as the feed at ``path`` leaves it: each key's last version."""
    return latest_by(spark.read.parquet(path).drop(BATCH), keys, [VERSION]).drop(KIND, VERSION)
