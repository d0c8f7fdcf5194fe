"""Reports and descriptive statistics. All are single-pass aggregates unless noted."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.functions.rows import one_row
from gridlore.operators.ranks import exact_quantiles_wide, percent_rank


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "registros") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out)).orderBy(*keys)


def category_report(df: DataFrame, digits: int = 2) -> DataFrame:
    """Market report of each category, dearest first."""
    return (df.groupBy("categoria").agg(
        F.count("item").alias("cantidad"),
        F.round(F.avg("valor"), digits).alias("precio_promedio"),
        F.min("valor").alias("precio_minimo"),
        F.max("valor").alias("precio_maximo")).orderBy(F.desc("precio_promedio"), "categoria"))


def group_ticket(df: DataFrame, group: str, digits: int = 2) -> DataFrame:
    return (df.filter(F.col("grupo") == group).groupBy("categoria").agg(
        F.count("item").alias("total"),
        F.round(F.avg("valor"), digits).alias("precio_medio"),
        F.max("fecha_captura").alias("ultima_sincronizacion")))


def brand_report(df: DataFrame, brand: Column, floor: float, digits: int = 6) -> DataFrame:
    return (df.filter(F.col("valor") > floor).groupBy(brand.alias("marca"))
            .agg(F.round(F.avg("valor"), digits).alias("precio_promedio"))
            .orderBy(F.desc("precio_promedio"), "marca"))


def value_summary(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int | None = None,
                  digits: int = 6, all_rows: bool = False) -> DataFrame:
    """Count, mean and maximum of ``valor`` per key; ``all_rows`` counts rows without a value too."""
    out = df.groupBy(*keys).agg(
        F.count("*" if all_rows else "valor").alias("registros"),
        F.round(F.avg("valor"), digits).alias("promedio"),
        F.max("valor").alias("maximo")).orderBy(*order)
    return out if limit is None else out.limit(limit)


def grouped_struct(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups under one compound key and flattens it again."""
    return (df.groupBy(F.struct(*keys).alias("_id"))
            .agg(F.count("*").alias("registros"), F.max("valor").alias("valor_maximo"))
            .select("_id.*", "registros", "valor_maximo").orderBy(keys[0], F.desc("registros"), *keys[1:]))


def null_profile(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _unpivot(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    return df.unpivot(list(ids), list(columns), "variable", "x")


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """One row per column, from one aggregate over the frame."""
    measures = {"n": F.count, "media": F.avg, "desviacion": F.stddev, "minimo": F.min, "maximo": F.max}
    row = df.agg(*[fn(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, fn in measures.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"n_{i}").alias("n"),
                 *[F.round(F.col(f"{name}_{i}").cast("double"), digits).alias(name) for name in measures if name != "n"])
        for i, c in enumerate(columns)])))


def quartiles(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Interpolated quartiles of each column."""
    named = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    wide = exact_quantiles_wide(_unpivot(df, columns), "x", named, by=["variable"], interpolate=True)
    return wide.select("variable", *[F.round(c, digits).alias(c) for c in named])


def skew_by(df: DataFrame, key: str, column: str) -> DataFrame:
    """Population skewness; null where the group has no spread."""
    return (df.groupBy(key).agg(
        F.count("*").alias("observaciones"),
        F.round(F.avg(column), 6).alias("media"),
        F.round(F.skewness(column), 4).alias("skewness")).orderBy(F.desc("observaciones"), key))


def boxplot(df: DataFrame, key: str, column: str, digits: int = 6) -> DataFrame:
    """Five-number summary per group with whisker limits."""
    named = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}
    quarts = exact_quantiles_wide(df, column, named, by=[key], interpolate=True)
    ends = df.groupBy(key).agg(F.min(column).alias("minimo"), F.max(column).alias("maximo"))
    spread = F.col("q3") - F.col("q1")
    ends = ends.withColumnRenamed(key, "_key")
    return quarts.join(ends, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, *[F.round(c, digits).alias(c) for c in ("minimo", "q1", "mediana", "q3", "maximo")],
        F.round(F.col("q1") - 1.5 * spread, digits).alias("bigote_inferior"),
        F.round(F.col("q3") + 1.5 * spread, digits).alias("bigote_superior"))


def correlation(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson matrix in long form, both triangles, from one aggregate. NaN where a column has no spread, null without rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.select(*columns).na.drop().agg(
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    spread = {c: F.col(f"s{i}") for i, c in enumerate(columns)}
    cells = []
    for i, (a, b) in enumerate(pairs):
        # not F.corr, which divides by a spread of 0 and fails
        r = F.when((spread[a] > 0) & (spread[b] > 0), F.col(f"c{i}") / spread[a] / spread[b]).when(
            spread[a].isNotNull(), F.lit(float("nan")))
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("fila"), F.lit(y).alias("columna"), F.round(r, digits).alias("valor")))
    return row.select(F.inline(F.array(*cells)))


def rank_correlation(df: DataFrame, columns: Sequence[str], row_id: Sequence[str], digits: int = 6) -> DataFrame:
    """Spearman matrix: Pearson over ``percent_rank``, where ties share the least rank.

    Ranks of all columns come from one pass over the unpivoted frame. Ranks are taken before rows with a null
    in any column are dropped, and that drop looks at every column of the frame.
    """
    complete = df.select(*row_id, *columns, F.forall(
        F.array(*[F.col(c).isNotNull() for c in df.columns]), lambda ok: ok).alias("_complete"))
    long = complete.unpivot([*row_id, "_complete"], list(columns), "variable", "x")
    ranked = percent_rank(long, "x", "pr", by=["variable"]).filter("_complete")
    wide = ranked.groupBy(*row_id).agg(*[F.max(F.when(F.col("variable") == c, F.col("pr"))).alias(c) for c in columns])
    return correlation(wide, columns, digits)


def confusion(df: DataFrame, label: str, prediction: str, values: Sequence) -> DataFrame:
    """Counts per label and prediction; the prediction columns are fixed, absent pairs are 0.

    A prediction outside ``values``, null included, is an error, so the counts always add up to all rows.
    """
    if not df.filter(~F.coalesce(F.col(prediction).isin(list(values)), F.lit(False))).isEmpty():
        raise ValueError(f"{prediction} has values other than {list(values)}")
    return df.groupBy(label).pivot(prediction, list(values)).count().na.fill(0).orderBy(label)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def scatter_loglog(df: DataFrame, x: str, y: str, keep: Sequence[str]) -> DataFrame:
    return df.filter((F.col(x) > 0) & (F.col(y) > 0)).select(
        *keep, F.round(F.log10(x), 9).alias("log_x"), F.round(F.log10(y), 9).alias("log_y"))


def standard_scale(df: DataFrame, columns: Sequence[str], keep: Sequence[str], digits: int = 6) -> DataFrame:
    """Columns to mean 0 and sample deviation 1; a constant column becomes 0."""
    stats = one_row(df.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns],
                           *[F.stddev(c).alias(f"sd_{c}") for c in columns]))
    scaled = [F.round(F.when(stats[f"sd_{c}"] > 0, (F.col(c) - stats[f"mean_{c}"]) / stats[f"sd_{c}"])
                      .otherwise(0.0), digits).alias(f"{c}_z") for c in columns]
    return df.select(*keep, *scaled)
