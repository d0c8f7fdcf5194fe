"""The long fact table: one row is one indicator value."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.functions.numbers import to_double

# fixed values: column names of the fact table, in output order
FACT_COLUMNS = [
    "fuente_sitio", "dataset", "url_origen", "grupo", "integrante", "tema",
    "fecha_extraccion", "pais", "region", "periodo", "indicador",
    "categoria_energia", "tecnologia", "actor", "item", "valor", "unidad",
    "scraper_origen",
]
_TYPED = {"periodo": T.IntegerType(), "valor": T.DoubleType()}
FACT_SCHEMA = T.StructType([T.StructField(c, _TYPED.get(c, T.StringType())) for c in FACT_COLUMNS])
TEXT_COLUMNS = [f.name for f in FACT_SCHEMA if isinstance(f.dataType, T.StringType)]


class SchemaError(ValueError):
    """A frame does not meet the columns an operator needs."""


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "input") -> DataFrame:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise SchemaError(f"{what} lacks columns: {missing}")
    return df


def project(df: DataFrame, schema: T.StructType = FACT_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones are null.

    A column already of the right type is passed through without a cast, so
    filters on it still reach the scan.
    """
    have = dict(df.dtypes)
    out = []
    for field in schema:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[field.name] == field.dataType.simpleString():
            out.append(F.col(field.name))
        else:
            value = to_double(field.name) if field.dataType.simpleString() == "double" else F.col(field.name).try_cast(field.dataType)
            out.append(value.alias(field.name))
    return df.select(*out)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def column_or(df: DataFrame, name: str, default: object = ""):
    """The column if the frame has it, else a constant."""
    return F.col(name) if name in df.columns else F.lit(default)
