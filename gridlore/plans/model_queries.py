"""Clustering, pseudo-labels and supervised models over the profile table."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from gridlore.operators import coreset, model_tables, modeling, stats
from gridlore.operators.dbscan import dbscan
from gridlore.operators.profiles import MODEL_FEATURES, PROFILE_KEY
from gridlore.plans import inputs
from gridlore.plans.inputs import PROFILE_SQL, table
from gridlore.plans.registry import query
from gridlore.session import materialize, new_path


def _scaled(spark, folder):
    return modeling.prepare_vectors(inputs.profile(spark, folder))


def _clustered(spark, folder, k: int = 3):
    """Profiles with vectors, principal components and their K-means cluster."""
    scaled = _scaled(spark, folder)
    with_pca = modeling.add_pca(scaled, modeling.fit_pca(scaled))
    return modeling.fit_kmeans(scaled, k).transform(with_pca)


def _sweep_frame(spark, sweep):
    return spark.createDataFrame(sweep, "k int, inercia double, silhouette double")


@query("pca_scores")
def pca_scores(spark, folder):
    scaled = _scaled(spark, folder)
    return modeling.add_pca(scaled, modeling.fit_pca(scaled)).select(
        *PROFILE_KEY, F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))


@query("pca_variance")
def pca_variance(spark, folder):
    scaled = _scaled(spark, folder)
    return modeling.explained_variance(scaled, modeling.fit_pca(scaled)).withColumn("varianza", F.round("varianza", 6))


@query("kmeans_sweep")
def kmeans_sweep(spark, folder):
    return _sweep_frame(spark, modeling.evaluate_k(_scaled(spark, folder)))


@query("kmeans_best_k")
def kmeans_best_k(spark, folder):
    sweep = modeling.evaluate_k(_scaled(spark, folder))
    return _sweep_frame(spark, sweep).filter(F.col("k") == modeling.best_k(sweep))


@query("kmeans_assign")
def kmeans_assign(spark, folder):
    return _clustered(spark, folder).select(*PROFILE_KEY, "prediction")


@query("kmeans_embeddings")
def kmeans_embeddings(spark, folder):
    """K-means over the given vectors, as counts per cluster and label."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("scaledFeatures"))
    rows = materialize(rows, "embedding-vectors")
    return modeling.fit_kmeans(rows, 5).transform(rows).groupBy("prediction", "label").agg(F.count("*").alias("vectores"))


@query("cluster_profile")
def cluster_profile(spark, folder):
    return modeling.cluster_profile(_clustered(spark, folder))


@query("kmeans_persist_roundtrip", f"WITH {PROFILE_SQL} SELECT count(*) AS filas, CAST(0 AS BIGINT) AS distintas FROM profile")
def kmeans_persist_roundtrip(spark, folder):
    """Counts rows whose cluster the reloaded model gives differently: always 0."""
    scaled = _scaled(spark, folder)
    model = modeling.fit_kmeans(scaled, 3)
    path = new_path(spark, "kmeans-model")
    model.write().overwrite().save(path)
    again = KMeansModel.load(path).setPredictionCol("reloaded")
    return again.transform(model.transform(scaled)).agg(
        F.count("*").alias("filas"), F.count_if(F.col("prediction") != F.col("reloaded")).alias("distintas"))


@query("kmeans_chosen_k", f"""
WITH {PROFILE_SQL} SELECT count(*) AS filas, CAST(0 AS BIGINT) AS lejanas, CAST(0 AS BIGINT) AS vacios FROM profile""")
def kmeans_chosen_k(spark, folder):
    """Assignment at the k of the best silhouette: rows not at their nearest centre and clusters without rows, always 0."""
    scaled = _scaled(spark, folder)
    k = modeling.best_k(modeling.evaluate_k(scaled))
    model = modeling.fit_kmeans(scaled, k)
    point = vector_to_array("scaledFeatures")

    def squared(centre):
        parts = F.zip_with(point, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)

    placed = model.transform(scaled).withColumn("d", F.array(*[squared(c) for c in model.clusterCenters()]))
    return placed.agg(
        F.count("*").alias("filas"), F.count_if(F.col("d")[F.col("prediction")] > F.array_min("d") + 1e-9).alias("lejanas"),
        (F.lit(k) - F.count_distinct("prediction")).cast("long").alias("vacios"))


@query("kmeans_coreset_checked", """
SELECT k, count(*) AS filas, true AS pocas, true AS cercano FROM embeddings, (VALUES (2), (4), (8)) t(k) GROUP BY k""")
def kmeans_coreset_checked(spark, folder):
    """K-means fitted on a coreset of the vectors: whether it is small, and its cost over all rows within 1.2 of the full fit's; always true."""
    rows = materialize(table(spark, folder, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("scaledFeatures")), "coreset-vectors")
    n, size, ks = rows.count(), 400, [2, 4, 8]
    small = coreset.coreset(rows, ["vec_id"], size).count() <= 2 * size
    full = coreset.costs(rows, [modeling.fit_kmeans(rows, k) for k in ks])
    found = coreset.sweep(rows, ["vec_id"], ks, size)
    return spark.createDataFrame([(k, n, small, cost <= 1.2 * whole) for (k, cost, _, _), whole in zip(found, full)],
                                 "k int, filas long, pocas boolean, cercano boolean")


@query("pseudo_labels")
def pseudo_labels(spark, folder):
    return stats.group_counts(modeling.pseudo_labels(_clustered(spark, folder)), ["label"])


def _split(spark, folder):
    return modeling.split_labelled(modeling.pseudo_labels(_clustered(spark, folder)), PROFILE_KEY)


def _held_out(spark, folder, name: str):
    _, predicted, _ = modeling.fit_classifier(name, *_split(spark, folder))
    return predicted.select(*PROFILE_KEY, "label", "prediction")


@query("clf_decision_tree")
def clf_decision_tree(spark, folder):
    return _held_out(spark, folder, "decision_tree")


@query("clf_tree_rules")
def clf_tree_rules(spark, folder):
    """The tree as text, one row per line; the heading with the random model name is left out."""
    model, _, _ = modeling.fit_classifier("decision_tree", *_split(spark, folder))
    lines = list(enumerate(model.toDebugString.rstrip().split("\n")[1:]))
    return spark.createDataFrame(lines, "linea int, regla string")


@query("clf_tree_confusion")
def clf_tree_confusion(spark, folder):
    return stats.confusion(_held_out(spark, folder, "decision_tree"), "label", "prediction", [0.0, 1.0, 2.0])


@query("clf_random_forest")
def clf_random_forest(spark, folder):
    return _held_out(spark, folder, "random_forest")


@query("clf_svm_ovr")
def clf_svm_ovr(spark, folder):
    return _held_out(spark, folder, "svm_one_vs_rest")


@query("clf_logistic")
def clf_logistic(spark, folder):
    return _held_out(spark, folder, "logistic")


@query("model_leaderboard")
def model_leaderboard(spark, folder):
    return modeling.leaderboard(*_split(spark, folder))


def _labelled(spark, folder):
    """All labelled profiles and their split; one K-means fit for all three."""
    labelled = materialize(modeling.pseudo_labels(_clustered(spark, folder)), "labelled")
    return labelled, *modeling.split_labelled(labelled, PROFILE_KEY)


def _by_descent(spark, folder, name: str):
    labelled, train, _ = _labelled(spark, folder)
    model = modeling.classifiers()[name].fit(train)
    nodes = materialize(model_tables.node_table(spark, model), "nodes")
    ours = model_tables.predict_by_nodes(labelled, nodes, PROFILE_KEY, "descenso", depth=5)
    return model.transform(labelled).join(ours, list(PROFILE_KEY), "left"), nodes, train


_KEYS_SQL = f"WITH {PROFILE_SQL} SELECT {', '.join(PROFILE_KEY)}, true AS igual FROM profile"


@query("clf_tree_descent", _KEYS_SQL)
def clf_tree_descent(spark, folder):
    """Whether the node table's descent gives each profile the class the decision tree gives it: always true."""
    scored, _, _ = _by_descent(spark, folder, "decision_tree")
    return scored.select(*PROFILE_KEY, F.col("prediction").eqNullSafe(F.col("descenso")).alias("igual"))


@query("clf_forest_descent", _KEYS_SQL)
def clf_forest_descent(spark, folder):
    """As ``clf_tree_descent``, with the votes of all trees of the random forest."""
    scored, _, _ = _by_descent(spark, folder, "random_forest")
    return scored.select(*PROFILE_KEY, F.col("prediction").eqNullSafe(F.col("descenso")).alias("igual"))


@query("clf_tree_nodes_sound", f"""
WITH {PROFILE_SQL} SELECT count(*) AS filas, CAST(0 AS BIGINT) AS hojas, CAST(0 AS BIGINT) AS sumas, CAST(0 AS BIGINT) AS impurezas,
       CAST(0 AS BIGINT) AS ganancias FROM profile""")
def clf_tree_nodes_sound(spark, folder):
    """Counts nodes whose rows, class counts, impurity or gain do not follow from the training rows: always 0."""
    scored, nodes, train = _by_descent(spark, folder, "decision_tree")
    faults = model_tables.node_faults(nodes, model_tables.descend(train.select(*PROFILE_KEY, "scaledFeatures"), nodes, depth=5))
    return faults.select(F.lit(scored.count()).alias("filas"), "*")


@query("clf_linear_weights", f"""
WITH {PROFILE_SQL} SELECT modelo, {', '.join(PROFILE_KEY)}, true AS igual FROM profile, (VALUES ('logistic'), ('svm_one_vs_rest')) m(modelo)""")
def clf_linear_weights(spark, folder):
    """Whether the greatest margin under the fitted weights is each profile's class in both linear models: always true."""
    labelled, train, _ = _labelled(spark, folder)
    out = None
    for name in ("logistic", "svm_one_vs_rest"):
        model = modeling.classifiers()[name].fit(train)
        same = F.col("prediction").eqNullSafe(model_tables.predict_by_weights(model_tables.weight_rows(model)))
        rows = model.transform(labelled).select(F.lit(name).alias("modelo"), *PROFILE_KEY, same.alias("igual"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("model_leaderboard_checked", """
SELECT * FROM (VALUES ('decision_tree', true, true), ('logistic', true, true), ('random_forest', true, true), ('svm_one_vs_rest', true, true))
AS t(modelo, igual, mejor_que_azar)""")
def model_leaderboard_checked(spark, folder):
    """The leaderboard's accuracies against those of the models scored as tables, and against the most frequent class."""
    _, train, test = _labelled(spark, folder)
    common = train.groupBy("label").count().orderBy(F.desc("count"), "label").first()["label"]
    floor = test.agg(F.avg((F.col("label") == common).cast("double"))).first()[0]
    rows = []
    for name in modeling.classifiers():
        model, _, accuracy = modeling.fit_classifier(name, train, test)
        if name in ("decision_tree", "random_forest"):
            ours = model_tables.predict_by_nodes(test, model_tables.node_table(spark, model), PROFILE_KEY, "prediction", depth=5)
            scored = test.join(ours, list(PROFILE_KEY), "left")
        else:
            scored = test.withColumn("prediction", model_tables.predict_by_weights(model_tables.weight_rows(model)))
        found = stats.accuracy(scored, "label", "prediction").first()[0]
        rows.append((name, abs(found - accuracy) < 1e-12, accuracy > floor))
    return spark.createDataFrame(rows, "modelo string, igual boolean, mejor_que_azar boolean")


@query("pca_checked", """
SELECT componente, true AS unitario, true AS ortogonal, true AS varianza_igual FROM (VALUES ('PC1'), ('PC2')) t(componente)""")
def pca_checked(spark, folder):
    """Loadings of length 1 and at right angles, and each component's share equal to its scores' variance over that of all features."""
    scaled = _scaled(spark, folder)
    model = modeling.fit_pca(scaled)
    pc = model.pc.toArray()
    x = vector_to_array("scaledFeatures")
    spread = scaled.select(*[x[i].alias(f"x{i}") for i in range(pc.shape[0])]).agg(
        sum(F.var_samp(f"x{i}") for i in range(pc.shape[0])).alias("total")).first()["total"]
    scores = modeling.add_pca(scaled, model).agg(*[F.var_samp(f"PC{i + 1}").alias(f"PC{i + 1}") for i in range(pc.shape[1])]).first()
    cross = pc.T @ pc
    return spark.createDataFrame([
        (f"PC{i + 1}", bool(abs(cross[i, i] - 1) < 1e-9), bool(max(abs(cross[i, j]) for j in range(len(cross)) if j != i) < 1e-9),
         bool(abs(scores[i] / spread - model.explainedVariance[i]) < 1e-9)) for i in range(pc.shape[1])],
        "componente string, unitario boolean, ortogonal boolean, varianza_igual boolean")


@query("linreg_intensity")
def linreg_intensity(spark, folder):
    _, _, metrics = modeling.fit_regression(inputs.profile(spark, folder), PROFILE_KEY)
    return spark.createDataFrame(list(metrics.items()), "metrica string, valor double")


@query("linreg_predictions")
def linreg_predictions(spark, folder):
    _, predicted, _ = modeling.fit_regression(inputs.profile(spark, folder), PROFILE_KEY)
    return predicted.select("periodo", "region", "categoria_energia", "label_intensidad", "prediccion_intensidad")


@query("dbscan_profiles")
def dbscan_profiles(spark, folder):
    """Density clusters of the profiles in the plane of their two principal components."""
    scaled = _scaled(spark, folder)
    scores = modeling.add_pca(scaled, modeling.fit_pca(scaled)).select(
        *PROFILE_KEY, "PC1", "PC2", F.xxhash64(*PROFILE_KEY).alias("row_id"))
    scores = materialize(scores, "pca-scores")
    return scores.join(dbscan(scores, "row_id", "PC1", "PC2"), "row_id").select(*PROFILE_KEY, "cluster_dbscan")


EPS, MIN_SAMPLES = 0.12, 6


def customer_points(spark, folder):
    """Customers by number and mean size of their orders, and their balance."""
    spent = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    return (table(spark, folder, "customer").join(spent, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", F.round(F.col("s") / F.col("n") / 50000, 3).alias("x"),
                    F.round(F.col("c_acctbal") / 2000, 3).alias("y")))


DBSCAN_SQL = f"""WITH RECURSIVE
points AS (SELECT c_custkey, round(s / n / 50000, 3) AS x, round(c_acctbal / 2000, 3) AS y
           FROM customer JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s FROM orders GROUP BY 1) o
                ON c_custkey = o_custkey),
near AS MATERIALIZED (
  SELECT a.c_custkey AS a, b.c_custkey AS b FROM points a JOIN points b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS} * {EPS}),
core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS c FROM roots),
border AS (SELECT a AS id, min(c) AS c FROM near JOIN numbered ON b = numbered.id
           WHERE a NOT IN (SELECT id FROM core) GROUP BY a)
"""


@query("dbscan_grid", DBSCAN_SQL + """
SELECT p.c_custkey, CAST(coalesce(n.c, b.c, -1) AS INTEGER) AS cluster_dbscan
FROM points p LEFT JOIN numbered n ON p.c_custkey = n.id LEFT JOIN border b ON p.c_custkey = b.id""")
def dbscan_grid(spark, folder):
    return dbscan(customer_points(spark, folder), "c_custkey", "x", "y", EPS, MIN_SAMPLES)


@query("dbscan_counts", DBSCAN_SQL + """
SELECT CAST(coalesce(n.c, b.c, -1) AS INTEGER) AS cluster_dbscan, count(*) AS registros
FROM points p LEFT JOIN numbered n ON p.c_custkey = n.id LEFT JOIN border b ON p.c_custkey = b.id GROUP BY 1""")
def dbscan_counts(spark, folder):
    clusters = dbscan(customer_points(spark, folder), "c_custkey", "x", "y", EPS, MIN_SAMPLES)
    return stats.group_counts(clusters, ["cluster_dbscan"])
