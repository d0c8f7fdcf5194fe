"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001
HOT_ROWS = 100_000
FANOUT = 64


def hot_keys(counts: DataFrame, keys: Sequence[str], count_col: str, rows: int) -> DataFrame | None:
    """Keys holding more than HOT_SHARE of all ``rows`` (and HOT_ROWS), with the number of parts to split each into.

    At most ``1 / HOT_SHARE`` keys can qualify, so the result is safe to broadcast whatever the data size. None where
    there are too few rows for any key to qualify.
    """
    if rows <= HOT_ROWS:
        return None
    return (counts.filter(F.col(count_col) > max(HOT_ROWS, int(rows * HOT_SHARE)))
            .select(*keys, F.lit(FANOUT).alias("_parts")))


def split_join(many: DataFrame, few: DataFrame, keys: Sequence[str], hot: DataFrame | None,
               spread: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where ``many`` may hold hot keys and ``few`` has a bounded number of rows per key.

    Rows of a hot key are dealt over parts by a hash of their ``spread`` columns and the matching rows of
    ``few`` are repeated once per part, so the result is the plain join's.
    """
    if hot is None:
        return many.join(few, list(keys), how)
    hot = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0)).cast("int")
    left = many.join(hot, list(keys), "left").withColumn("_part", part).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    right = few.join(hot, list(keys), "left").withColumn("_part", F.explode(parts)).drop("_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")
