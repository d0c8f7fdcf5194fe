"""Samples and splits that depend on row keys, not on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seeded(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys],
                             F.lit(str(seed))))


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows, the same for the same seed whatever the layout."""
    return df.orderBy(_seeded(keys, seed), *keys).limit(n)


def split_bucket(keys: Sequence[str], seed: int) -> Column:
    """0..99 from the first 28 bits of the seeded hash."""
    return F.conv(F.substring(_seeded(keys, seed), 1, 7), 16, 10).cast("int") % 100


def train_test_split(df: DataFrame, keys: Sequence[str], train_share: float = 0.7,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn("_bucket", split_bucket(keys, seed))
    cut = round(train_share * 100)
    return tagged.filter(F.col("_bucket") < cut).drop("_bucket"), tagged.filter(F.col("_bucket") >= cut).drop("_bucket")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Best ``k`` rows: each task keeps k, no global sort."""
    return df.orderBy(*order).limit(k)
