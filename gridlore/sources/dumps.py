"""Dumps of document stores: one document a line in extended JSON, read and written by Spark's own JSON source.

Values beyond plain JSON stand in one-field wrappers: ``{"$oid": ..}``, ``{"$date": ..}``, ``{"$numberLong": ".."}`` and the like.
Files are split by bytes, so one large dump is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Wrappers of numbers and of text (fixed values of the format).
NUMBER_WRAPPERS = ("$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")
TEXT_WRAPPERS = ("$oid", "$uuid", "$symbol", "$code")
_DAMAGED = "damaged line"


def _inside(raw: Column, *wrappers: str) -> Column:
    """The content of the first wrapper found, null for a plain value."""
    found = [F.get_json_object(raw, f"$['{w}']") for w in wrappers]
    return F.when(raw.startswith("{"), F.coalesce(*found))


def _number(raw: Column) -> Column:
    return F.coalesce(_inside(raw, *NUMBER_WRAPPERS), raw)


def _moment(raw: Column) -> Column:
    """From ``$date`` as milliseconds, bare or wrapped, or as ISO text; plain values likewise."""
    date = F.coalesce(_inside(raw, "$date"), raw)
    digits = _number(date)
    millis = F.when(digits.rlike(r"^-?[0-9]+$"), digits.try_cast("long"))
    return F.coalesce(F.timestamp_millis(millis), F.when(millis.isNull(), date.try_cast("timestamp")))


def _decoded(raw: Column, kind: T.DataType) -> Column:
    """The value of ``kind`` in a raw JSON text; null where it has none."""
    if isinstance(kind, T.StructType):
        parts = F.from_json(raw, T.StructType([T.StructField(f.name, T.StringType()) for f in kind]))
        return F.when(raw.startswith("{"), F.struct(*[_decoded(parts[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, T.ArrayType):
        return F.transform(F.from_json(raw, T.ArrayType(T.StringType())), lambda item: _decoded(item, kind.elementType))
    if isinstance(kind, T.TimestampType):
        return _moment(raw)
    if isinstance(kind, T.DateType):
        return _moment(raw).cast("date")
    if isinstance(kind, T.BinaryType):
        inner = _inside(raw, "$binary")
        return F.try_to_binary(F.coalesce(F.get_json_object(inner, "$.base64"), inner), F.lit("base64"))
    if isinstance(kind, (T.IntegralType, T.FractionalType)):
        return _number(raw).try_cast(kind)
    if isinstance(kind, T.BooleanType):
        return raw.try_cast(kind)
    if isinstance(kind, T.StringType):
        return F.when(~raw.startswith('{"$undefined"'), F.coalesce(_inside(raw, *TEXT_WRAPPERS), raw))
    raise TypeError(f"no value of a document has the type {kind.simpleString()}")


def read_dump(spark: SparkSession, path: str | list[str], schema: T.StructType | str, only: Mapping[str, str] | None = None,
              damaged: bool = False) -> DataFrame:
    """The documents at ``path`` with the columns of ``schema``, wrappers taken off.

    Fields a document lacks are null, as are values that do not fit their type; other fields are not read. ``only`` keeps documents
    whose plain text fields have the given values: the comparison is pushed into the scan, which does not
    build the other rows. A line that is no document is left out; with ``damaged`` the rows returned are these lines instead, in
    one column ``line``.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    unknown = [name for name in only or {} if name not in wanted.fieldNames() or not isinstance(wanted[name].dataType, T.StringType)]
    if unknown:
        raise ValueError(f"not a text column of the schema: {', '.join(unknown)}")
    fields = [T.StructField(f.name, T.StringType()) for f in wanted]
    if damaged:
        raw = spark.read.schema(T.StructType([*fields, T.StructField(_DAMAGED, T.StringType())])).json(path, columnNameOfCorruptRecord=_DAMAGED)
        # the reader refuses a query of this column alone
        parsed = F.length(F.concat_ws("", *[F.col(f"`{f.name}`") for f in fields])) >= 0
        return raw.filter(F.col(f"`{_DAMAGED}`").isNotNull() & parsed).select(F.col(f"`{_DAMAGED}`").alias("line"))
    raw = spark.read.schema(T.StructType(fields)).json(path, mode="DROPMALFORMED")
    for name, value in (only or {}).items():
        raw = raw.filter(F.col(f"`{name}`") == value)
    return raw.select(*[_decoded(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in wanted])


def _extended(value: Column, kind: T.DataType) -> Column:
    def wrapped(name: str, inner: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(inner.alias(name)))

    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_extended(value[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _extended(item, kind.elementType))
    if isinstance(kind, (T.TimestampType, T.DateType)):
        millis = F.unix_millis(value.cast("timestamp")).cast("string")
        return wrapped("$date", F.struct(millis.alias("$numberLong")))
    if isinstance(kind, T.LongType):
        return wrapped("$numberLong", value.cast("string"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return wrapped("$numberDouble", value.cast("string"))
    if isinstance(kind, T.DecimalType):
        return wrapped("$numberDecimal", value.cast("string"))
    if isinstance(kind, T.BinaryType):
        return wrapped("$binary", F.struct(F.base64(value).alias("base64"), F.lit("00").alias("subType")))
    return value


def write_dump(df: DataFrame, path: str, object_ids: Iterable[str] = (), mode: str = "errorifexists") -> None:
    """One document a row in extended JSON; null fields are left out, moments keep their milliseconds. ``object_ids`` names text columns written as ``$oid``."""
    ids = set(object_ids)
    columns = [F.when(F.col(f"`{f.name}`").isNotNull(), F.struct(F.col(f"`{f.name}`").alias("$oid"))) if f.name in ids
               else _extended(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    df.select(*[c.alias(f.name) for c, f in zip(columns, df.schema)]).write.mode(mode).json(path)
