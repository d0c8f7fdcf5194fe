"""The latest period that every dataset covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.functions.numbers import parse_int


def _dataset_years(df: DataFrame) -> DataFrame:
    """Distinct (dataset, periodo); datasets without a valid year drop out here."""
    year = F.col("periodo") if dict(df.dtypes)["periodo"] == "int" else parse_int("periodo")
    return (df.select("dataset", year.alias("periodo"))
            .filter(F.col("dataset").isNotNull() & F.col("periodo").isNotNull()).distinct())


def years_by_dataset(df: DataFrame) -> DataFrame:
    return _dataset_years(df).groupBy("dataset").agg(F.array_sort(F.collect_set("periodo")).alias("periodos"))


def common_year(df: DataFrame, year: int | None = None) -> DataFrame:
    """One row with the common period. Null where there is none, or where ``year`` is not in all datasets."""
    pairs = _dataset_years(df)
    covered = pairs.groupBy("periodo").agg(F.count("*").alias("_n"))
    if year is not None:
        covered = covered.filter(F.col("periodo") == year)
    datasets = pairs.agg(F.countDistinct("dataset")).scalar()
    return covered.filter(F.col("_n") == datasets).agg(F.max("periodo").alias("periodo"))


def missing_datasets(df: DataFrame, year: int) -> DataFrame:
    """Datasets that have valid years but not this one."""
    return (_dataset_years(df).groupBy("dataset").agg(F.max(F.col("periodo") == year).alias("_has"))
            .filter(~F.col("_has")).select("dataset"))


def keep_common_year(df: DataFrame, year: int | None = None) -> DataFrame:
    """Rows of the common period, in one lazy plan; rows without a period vanish. Prunes partitions by period."""
    return df.filter(F.col("periodo") == common_year(df, year).scalar())


def resolve_common_year(df: DataFrame, year: int | None = None) -> int:
    """The common period as a number, with the reason when there is none."""
    found = common_year(df, year).first()["periodo"]
    if found is not None:
        return found
    if _dataset_years(df).isEmpty():
        raise ValueError("no dataset has a valid period")
    if year is None:
        raise ValueError("the datasets share no period")
    lacking = missing_datasets(df, year).agg(F.array_join(F.array_sort(F.collect_set("dataset")), ", ").alias("names")).first()["names"]
    raise ValueError(f"period {year} is not in all datasets; lacking: {lacking}")
