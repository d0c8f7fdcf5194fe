"""The four jobs end to end: integrate, explore, cluster, supervise. All output is written by the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.functions.text import record_key
from gridlore.operators import modeling, periods, profiles, stats
from gridlore.operators.cleaning import analysis_facts, clean_facts
from gridlore.operators.dbscan import dbscan
from gridlore.operators.merge import upsert_table
from gridlore.schema import FACT_COLUMNS
from gridlore.session import materialize
from gridlore.sources import sinks
from gridlore.sources.registry import SourceRegistry

# fixed values: density settings
EPS, MIN_SAMPLES = 0.5, 5
# how the stored table is partitioned (part of the record key), and which row wins among those sharing a key
STORE_PARTITIONS = ["dataset", "periodo"]
NEWEST = ["fecha_extraccion", "valor"]


def keyed(facts: DataFrame) -> DataFrame:
    """Facts with their record key, which leaves out the value: several rows can share one."""
    return facts.select(record_key().alias("registro_id"), *FACT_COLUMNS)


def integrate(spark: SparkSession, registry: SourceRegistry, folder: str, store: str, export: str | None = None,
              year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Sources to the stored table: the clean facts of the common period, and the upsert counters."""
    raw = materialize(registry.load_all(spark, folder), "raw-facts")
    if raw.isEmpty():
        raise RuntimeError("the sources gave no rows")
    period = periods.resolve_common_year(raw, year)
    clean = materialize(clean_facts(raw.filter(F.col("periodo") == period)), "clean-facts")
    if clean.isEmpty():
        raise RuntimeError("cleaning left no rows")
    counters = upsert_table(store, keyed(clean), "registro_id", STORE_PARTITIONS, NEWEST)
    if export:
        sinks.export_csv(clean, f"{export}/csv")
        sinks.export_json(clean, f"{export}/json")
    return clean, counters


def explore(facts: DataFrame, out: str) -> DataFrame:
    """Profiles with outliers marked; writes them, their statistics and both correlation matrices."""
    analysed = materialize(analysis_facts(facts), "analysed-facts")
    profile = materialize(profiles.profile_features(analysed), "profile")
    features = materialize(profiles.flag_outliers(profile, "intensidad_co2", "es_outlier_intensidad"), "features")
    reports = {
        "nulos": stats.null_profile(analysed),
        "resumen": stats.describe(features, profiles.FEATURES),
        "limites_iqr": profiles.iqr_bounds(features, "intensidad_co2"),
        "outliers": stats.group_counts(features, ["es_outlier_intensidad"]),
        "categorias": stats.skew_by(features, "categoria_energia", "intensidad_co2"),
        "cajas": stats.boxplot(features, "categoria_energia", "intensidad_co2"),
        "dispersion": stats.scatter_loglog(features, "generacion_mwh", "emisiones_co2_mt", profiles.PROFILE_KEY),
        "correlacion_pearson": stats.correlation(features, profiles.FEATURES),
        "correlacion_spearman": stats.rank_correlation(features, profiles.FEATURES, profiles.PROFILE_KEY),
    }
    sinks.export_csv(features, f"{out}/features", profiles.PROFILE_KEY)
    for name, report in reports.items():
        report.write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
    return features


def cluster(features: DataFrame, out: str, eps: float = EPS, min_samples: int = MIN_SAMPLES) -> tuple[DataFrame, int]:
    """Clustered profiles and the chosen k; writes them, the model, the k sweep and the density clusters."""
    positive = features.filter((F.col("generacion_mwh") > 0) & (F.col("emisiones_co2_mt") > 0))
    scaled = modeling.prepare_vectors(positive)
    pca = modeling.fit_pca(scaled)
    sweep = modeling.evaluate_k(scaled)
    k = modeling.best_k(sweep)
    model = modeling.fit_kmeans(scaled, k)
    clustered = materialize(model.transform(modeling.add_pca(scaled, pca)), "clustered")
    clustered.write.mode("overwrite").parquet(f"{out}/datos_etiquetados_kmeans")
    model.write().overwrite().save(f"{out}/modelo_kmeans")
    spark = features.sparkSession
    spark.createDataFrame(sweep, "k int, inercia double, silhouette double").coalesce(1).write.mode("overwrite").option(
        "header", True).csv(f"{out}/evaluacion_kmeans")
    modeling.explained_variance(scaled, pca).write.mode("overwrite").option("header", True).csv(f"{out}/varianza_pca")
    modeling.cluster_profile(clustered).write.mode("overwrite").option("header", True).csv(f"{out}/perfil_clusters")
    # rows are numbered once and stored with their number, which orders the density clusters
    rows = materialize(clustered.select(
        *profiles.PROFILE_KEY, "generacion_mwh", "emisiones_co2_mt", "intensidad_co2", "PC1", "PC2",
        F.col("prediction").alias("cluster_kmeans"), F.monotonically_increasing_id().alias("_fila")), "cluster-rows")
    density = rows.join(dbscan(rows, "_fila", "PC1", "PC2", eps, min_samples), "_fila").drop("_fila")
    sinks.export_csv(density, f"{out}/clusters_dbscan", profiles.PROFILE_KEY)
    return clustered, k


def supervise(clustered: DataFrame, out: str, keys: Sequence[str] = tuple(profiles.PROFILE_KEY)) -> DataFrame:
    """Leaderboard of the classifiers; writes it with the tree's confusion and predictions and the regression."""
    labelled = modeling.pseudo_labels(clustered)
    train, test = modeling.split_labelled(labelled, keys)
    board = modeling.leaderboard(train, test)
    tree, predicted, _ = modeling.fit_classifier("decision_tree", train, test)
    classes = [float(i) for i in range(tree.numClasses)]
    _, regression, metrics = modeling.fit_regression(labelled, keys)
    spark = clustered.sparkSession
    reports = {
        "metricas_clasificacion": board,
        "matriz_confusion_arbol": stats.confusion(predicted, "label", "prediction", classes),
        "predicciones_arbol": predicted.select("region", "categoria_energia", "label", "prediction"),
        "predicciones_regresion": regression.select(
            "region", "categoria_energia", "label_intensidad", "prediccion_intensidad"),
        "metricas_regresion": spark.createDataFrame([tuple(metrics.values())], [*metrics]),
    }
    for name, report in reports.items():
        report.write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
    return board
