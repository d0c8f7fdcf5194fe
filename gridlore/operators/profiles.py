"""Wide profiles: one row per period, region and category with derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlore.functions.rows import one_row
from gridlore.operators.ranks import exact_quantiles_wide

# fixed values: names of the compared measures and of the derived features
GENERATION, EMISSIONS = "generacion_electrica", "emisiones_co2"
PROFILE_KEY = ["periodo", "region", "categoria_energia"]
FEATURES = ["generacion_mwh", "emisiones_co2_mt", "intensidad_co2", "participacion_generacion"]
MODEL_FEATURES = ["log_generacion", "log_emisiones", "intensidad_co2", "participacion_generacion"]
WHISKER = 1.5


def aligned_measures(facts: DataFrame) -> DataFrame:
    """Both measures side by side where both are positive: one shuffle, no join."""
    def total(name: str) -> Column:
        return F.sum(F.when(F.col("indicador") == name, F.col("valor")).otherwise(0.0))
    return (facts.filter(F.col("indicador").isin(GENERATION, EMISSIONS))
            .groupBy(*PROFILE_KEY)
            .agg(total(GENERATION).alias("generacion_mwh"), total(EMISSIONS).alias("emisiones_co2_mt"))
            .filter((F.col("generacion_mwh") > 0) & (F.col("emisiones_co2_mt") > 0)))


def aligned_measures_by_join(facts: DataFrame) -> DataFrame:
    """The same table as an inner join of two aggregates; kept to test the form above."""
    def side(name: str, out: str) -> DataFrame:
        return (facts.filter(F.col("indicador") == name).groupBy(*PROFILE_KEY)
                .agg(F.sum("valor").alias(out)).filter(F.col(out) > 0))
    left, right = side(GENERATION, "generacion_mwh"), side(EMISSIONS, "emisiones_co2_mt")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in PROFILE_KEY})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in PROFILE_KEY]
    return left.join(renamed, on).select(*PROFILE_KEY, "generacion_mwh", "emisiones_co2_mt")


def derive_features(aligned: DataFrame) -> DataFrame:
    """Ratios and logs. The window holds the categories of one region and period, already aggregated."""
    region = Window.partitionBy("periodo", "region")
    return (aligned
            .withColumn("total_generacion_region", F.sum("generacion_mwh").over(region))
            .withColumns({
                "intensidad_co2": F.col("emisiones_co2_mt") / F.col("generacion_mwh"),
                "participacion_generacion": F.col("generacion_mwh") / F.col("total_generacion_region"),
                "log_generacion": F.log1p("generacion_mwh"),
                "log_emisiones": F.log1p("emisiones_co2_mt"),
            }))


def add_zscore(df: DataFrame, column: str, out: str) -> DataFrame:
    """Global z-score with the sample deviation; 0 where there is none. Stays lazy."""
    stats = one_row(df.agg(F.avg(column).alias("mean"), F.stddev(column).alias("sd")))
    return df.withColumn(out, F.when(stats["sd"] > 0, (F.col(column) - stats["mean"]) / stats["sd"]).otherwise(0.0))


def profile_features(facts: DataFrame) -> DataFrame:
    return add_zscore(derive_features(aligned_measures(facts)), "intensidad_co2", "z_intensidad")


def iqr_bounds(df: DataFrame, column: str, relative_error: float = 0.0) -> DataFrame:
    """One row ``q1, q3, lower, upper``; nulls for empty input. Error 0 takes the exact quartiles."""
    if relative_error > 0:
        quartiles = F.percentile_approx(column, [0.25, 0.75], int(1 / relative_error))
        row = df.agg(quartiles.alias("_q")).select(F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    else:
        row = exact_quantiles_wide(df, column, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return row.select("q1", "q3", (F.col("q1") - WHISKER * spread).alias("lower"),
                      (F.col("q3") + WHISKER * spread).alias("upper"))


def flag_outliers(df: DataFrame, column: str, out: str, relative_error: float = 0.0) -> DataFrame:
    """Marks rows strictly outside the whiskers."""
    bounds = one_row(iqr_bounds(df, column, relative_error))
    outside = (F.col(column) < bounds["lower"]) | (F.col(column) > bounds["upper"])
    return df.withColumn(out, F.coalesce(outside, F.lit(False)))
