"""Small helpers the operators share: tables, words, salts and written intermediate tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern `[^\x20\x09-\x0D]+`.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``docs`` is called so in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def without_white(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def salt_of(spark: SparkSession, *columns: str) -> Column:
    """One of as many salts as there are shuffle partitions: a key's rows can reach every task."""
    return F.pmod(F.xxhash64(F.lit("salt"), *columns), F.lit(partitions(spark))).cast("int")


#: log2 of the bits of the map that tells whose text a join may need: 2 MB, whatever the data.
ID_BITS = 24


def _bitmap(positions: DataFrame, column: str, bits: int):
    """``2**bits`` bits as 64-bit words, those at ``column`` (0 to 2**bits - 1) set."""
    import numpy as np

    words = positions.groupBy(F.shiftright(column, 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({column} & 63 as int)))").alias("mask")).toArrow()
    found = np.zeros(1 << (bits - 6), dtype=np.uint64)
    if words.num_rows:
        found[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return found


def broadcast_bits(positions: DataFrame, column: str, bits: int):
    """Broadcast bitmap of ``2**bits`` bits with the bits at ``column`` (0 to 2**bits - 1) set.

    Its size is fixed whatever the data, so it serves as a filter that may pass too much, never too little.
    """
    return positions.sparkSession.sparkContext.broadcast(_bitmap(positions, column, bits))


def _held(words, at: Column) -> Column:
    """The word at ``at`` of the array ``words``, as an expression over the rows of any table."""
    import numpy as np
    import pyarrow as pa

    values = pa.array(words.view(np.int64))
    table = pa.table({"words": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)})
    return F.get(SparkSession.active().createDataFrame(table).scalar(), at.cast("int"))


def _slot(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def may_hold(rows: DataFrame, key: str = "doc_id", bits: int = ID_BITS) -> Column:
    """Whether ``rows`` may have the value of the column ``key``: false only where they do not have it.

    A table whose texts are wanted of few rows is filtered by this before it is shuffled.
    """
    at = _slot(key, bits)
    words = _bitmap(rows.select(at.alias("at")), "at", bits)
    return F.getbit(_held(words, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def class_held(rows: DataFrame, key: str = "doc_id", bits: int = ID_BITS) -> Column:
    """The class (column ``class``) that ``rows`` have for the value of ``key``, if it is 0, 1 or 2 and the only one there; else 3.

    Two bits a hash: the value is part of the plan, which the driver holds several times.
    """
    import numpy as np

    at = _slot(key, bits)
    each = rows.groupBy(at.alias("at")).agg(F.min("class").alias("least"), F.max("class").alias("most"))
    code = F.when((F.col("least") == F.col("most")) & (F.col("least") < 3), F.col("least")).otherwise(3).cast("long")
    table = each.select("at", code.alias("code")).groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(code, cast(at & 31 as int) * 2))").alias("codes")).toArrow()
    words = np.zeros(1 << (bits - 5), dtype=np.uint64)
    if table.num_rows:
        words[table["word"].to_numpy()] = table["codes"].to_numpy().view(np.uint64)
    place = (at.bitwiseAND(F.lit(31)) * 2).cast("int")
    return F.call_function("shiftright", _held(words, F.shiftright(at, 5)), place).bitwiseAND(F.lit(3)).cast("int")


def released(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` over a task's batches; afterwards freed memory goes back to the system.

    Python workers stay up between tasks and stages, beside the heap of their executor.
    """

    def wrapped(batches: Iterable) -> Iterator:
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped
