"""Readers of landed files. Schemas are always given; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.functions.text import snake, snake_columns, snake_name


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header line. Cells with line breaks need ``multiline``, which reads a file in one task."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)


#: Conditions that say a source is not there; any other error is not taken for absence.
_ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "DATA_SOURCE_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv_with_banner(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV whose header comes after banner lines.

    The header is the line that repeats the column names. Lines before it in the split that starts a file, with text in
    the first cell only, are banners; rows of that look after it are data. Files are still split over tasks. A file
    without a header has no banner.
    """
    names = [f.name for f in schema]
    raw = spark.read.schema(_texts(names)).option("escape", '"').csv(path).select(
        *names, F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_first"),
        F.monotonically_increasing_id().alias("_place"))
    header = F.lit(True)
    for n in names:
        header = header & F.coalesce(snake(n) == snake_name(n), F.lit(False))
    banner = F.forall(F.array(*[F.col(n).isNull() for n in names[1:]]), lambda empty: empty)
    heads = raw.filter(header & F.col("_first")).groupBy("_file").agg(F.min("_place").alias("_head"))
    ahead = banner & F.col("_first") & F.coalesce(F.col("_place") < F.col("_head"), F.lit(False))
    rows = raw.join(heads, "_file", "left").filter(~header & ~ahead)
    typed = [F.col(f.name) if isinstance(f.dataType, T.StringType)
             else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return snake_columns(rows.select(*typed))


def read_parts(spark: SparkSession, paths: Sequence[str], columns: Callable[[str], Sequence[str]],
               needed: str = "proyecto") -> DataFrame:
    """Parts with their own headers under one tag column ``dataset``, the snake_case file or folder name.

    ``columns`` gives a part's column names. Parts without the needed column are skipped; columns only some parts
    have are null elsewhere. All values stay text.
    """
    parts = []
    for path in paths:
        names = [snake_name(n) for n in columns(path)]
        if needed not in names:
            continue
        tag = snake_name(path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv"))
        part = snake_columns(read_csv_with_banner(spark, path, _texts(columns(path))))
        parts.append(part.withColumn("dataset", F.lit(tag)))
    if not parts:
        raise ValueError(f"no part has the column {needed!r}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_collection(spark: SparkSession, schema: T.StructType, fmt: str = "json", path: str | None = None,
                    **options: str) -> DataFrame:
    """A document collection: JSON or Parquet files, or a connector format such as ``mongodb``."""
    reader = spark.read.format(fmt).schema(schema).options(**options)
    return reader.load(path) if path else reader.load()


def read_first_available(candidates: Sequence[tuple[str, Callable[[], DataFrame]]],
                         only: str | None = None) -> tuple[DataFrame, str]:
    """The first source that opens and has a row, with its name; ``only`` forces one by name."""
    reasons = []
    for name, opener in candidates:
        if only is not None and name != only:
            continue
        try:
            df = opener()
            if not df.isEmpty():
                return df, name
            reasons.append(f"{name}: empty")
        except PySparkException as error:
            if error.getCondition() not in _ABSENT:
                raise
            reasons.append(f"{name}: {str(error).splitlines()[0]}")
    raise FileNotFoundError(f"no source has data ({'; '.join(reasons) or 'none given'})")
