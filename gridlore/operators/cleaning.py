"""Normalising, filtering, checking and deduplicating fact rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlore.functions.numbers import parse_int, parse_number
from gridlore.functions.text import DEFAULT_CATEGORY, blank_to_null
from gridlore.schema import FACT_COLUMNS, FACT_SCHEMA, TEXT_COLUMNS, project, require_columns

# fixed values: what makes two facts the same, at integration and in the analysis
INTEGRATION_KEY = ["dataset", "item", "periodo", "indicador", "integrante", "valor"]
ANALYSIS_KEY = ["dataset", "region", "periodo", "indicador", "tecnologia", "actor", "valor"]
ANALYSIS_DATASETS = ["annual_generation_state", "emission_annual"]
SUBTOTALS = ["Total", "All Sources"]
# lower 40 bits of a sort hash, those that tell the numbers of a key apart
_LOW = (1 << 40) - 1


def normalize(df: DataFrame, columns: Sequence[str] = tuple(FACT_COLUMNS)) -> DataFrame:
    """Typed, trimmed fact rows from whatever a source returned, with all fact columns or some of them."""
    types = dict(df.dtypes)
    numbers = {}
    if types.get("valor", "double") != "double":
        numbers["valor"] = parse_number("valor", types["valor"])
    if types.get("periodo", "int") != "int":
        numbers["periodo"] = parse_int("periodo")
    schema = StructType([f for f in FACT_SCHEMA if f.name in columns])
    facts = project(df.withColumns(numbers) if numbers else df, schema)
    return facts.withColumns({c: blank_to_null(c) for c in TEXT_COLUMNS if c in columns})


def positive(value: str = "valor") -> Column:
    """Not null, not NaN (which Spark ranks above every number) and above zero."""
    return (F.col(value) > 0) & ~F.isnan(value)


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; nulls are equal. The kept row is the least by its other columns.

    An aggregate, so each task sends on one row per key however often the key
    occurs, and the kept row does not depend on partitioning.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    # rows are sorted by key within a task, at first by eight bytes of the leading column: a hash tells most keys apart, and its
    # upper bits come from the text alone, so rows of one text stand together and are written small; then numbers, which compare
    # faster than text
    text = [c for c in keys if dict(df.dtypes)[c] == "string"]
    numbers = [c for c in keys if c not in text]
    lead = F.xxhash64(*(text or numbers))
    if text and numbers:
        lead = lead.bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.xxhash64(*numbers).bitwiseAND(F.lit(_LOW)))
    kept = df.groupBy(lead.alias("_hash"), *numbers, *text).agg(F.min(F.struct(*rest)).alias("_rest"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in df.columns])


def clean_facts(df: DataFrame, columns: Sequence[str] = tuple(FACT_COLUMNS)) -> DataFrame:
    """Integration rules: positive value, named item, no repeats, a category on every row.

    Name only the ``columns`` the caller goes on with (the integration key and the category at least): the rest
    is then neither read nor shuffled.
    """
    valid = normalize(df, columns).filter(positive() & F.col("item").isNotNull())
    return distinct_by(valid, INTEGRATION_KEY).withColumn(
        "categoria_energia", F.coalesce("categoria_energia", F.lit(DEFAULT_CATEGORY)))


def select_for_analysis(df: DataFrame, datasets: Sequence[str] = tuple(ANALYSIS_DATASETS)) -> DataFrame:
    require_columns(df, ["region", "categoria_energia", "indicador", "valor", "dataset"], "analysis input")
    typed = df.withColumns({"region": blank_to_null("region"), "categoria_energia": blank_to_null("categoria_energia")})
    kinds = dict(df.dtypes)
    for name, wanted in (("valor", "double"), ("periodo", "int")):
        if kinds.get(name, wanted) != wanted:
            typed = typed.withColumn(name, F.col(name).try_cast(wanted))
    return typed.filter(
        F.col("dataset").isin(*datasets) & positive()
        & F.col("region").isNotNull() & F.col("categoria_energia").isNotNull())


def analysis_facts(df: DataFrame, datasets: Sequence[str] = tuple(ANALYSIS_DATASETS)) -> DataFrame:
    """Rows of the compared datasets, once each."""
    return distinct_by(select_for_analysis(df, datasets), ANALYSIS_KEY)


def exclude_members(df: DataFrame, members: Mapping[str, Sequence[str]]) -> DataFrame:
    """Drops rows naming a subtotal; a null member stays."""
    for column, names in members.items():
        df = df.filter(~F.coalesce(F.col(column).isin(*names), F.lit(False)))
    return df


def quality_checks(df: DataFrame, min_rows: int = 100, min_columns: int = 8) -> DataFrame:
    """One row of booleans, from one pass."""
    return df.agg(
        (F.count("*") >= min_rows).alias("enough_rows"),
        F.lit(len(df.columns) >= min_columns).alias("enough_columns"),
        F.coalesce(F.min("periodo") == F.max("periodo"), F.lit(False)).alias("one_year"),
        (F.count("*") > 0).alias("not_empty"),
    )
