"""Writers. All write from the executors; exports replace what an earlier run left."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: row order of the export
EXPORT_ORDER = ["integrante", "dataset", "item"]


def _ordered(df: DataFrame, order: Sequence[str], as_text: Sequence[str]) -> DataFrame:
    """Sorted with all other columns as tie-breakers, so that rows equal in ``order`` can be split over tasks."""
    rows = df.orderBy(*order, *[c for c in df.columns if c not in order])
    return rows.withColumns({c: F.col(c).cast("string") for c in as_text}) if as_text else rows


def export_csv(df: DataFrame, path: str, order: Sequence[str] = tuple(EXPORT_ORDER),
               as_text: Sequence[str] = (), compression: str = "none") -> None:
    """Ordered CSV: files in name order hold the rows in order. Blank and null cells stay apart."""
    _ordered(df, order, as_text).write.option("header", True).option("escape", '"').option("nullValue", "").option(
        "emptyValue", '""').option("compression", compression).mode("overwrite").csv(path)


def export_json(df: DataFrame, path: str, order: Sequence[str] = tuple(EXPORT_ORDER),
                as_text: Sequence[str] = (), compression: str = "none") -> None:
    """Ordered JSON records, one per line; fields that are null are written too. A compressed file is read by one task."""
    _ordered(df, order, as_text).write.option("ignoreNullFields", False).option("compression", compression).mode("overwrite").json(path)


def write_facts(df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset", "periodo")) -> None:
    """The fact table, partitioned so that a dataset or period is read alone."""
    balanced = df.hint("rebalance", *partition_by)
    balanced.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


