"""Node tables and weights against the models they come from."""

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from gridlore.operators import model_tables


def frame(spark, n=400):
    rows = spark.range(n).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("double").alias("b"))
    rows = rows.withColumn("label", F.when(F.col("b").isin(1.0, 3.0), 2.0).when(F.col("a") > 5, 1.0).otherwise(0.0))
    rows = rows.withColumn("label", F.when(F.col("id") % 11 == 0, F.pmod(F.col("label") + 1, F.lit(3.0))).otherwise(F.col("label")))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="raw").transform(rows)
    return VectorIndexer(inputCol="raw", outputCol="scaledFeatures", maxCategories=6).fit(vectors).transform(vectors)


def differing(model, df, nodes, **kw):
    ours = model_tables.predict_by_nodes(df, nodes, ["id"], "ours", **kw)
    both = model.transform(df).join(ours, "id")
    assert both.count() == df.count()
    return both.filter("prediction <> ours").count()


def test_trees_with_categories_and_thresholds(spark, monkeypatch):
    df = frame(spark).cache()
    tree = DecisionTreeClassifier(featuresCol="scaledFeatures", maxDepth=4, seed=1).fit(df)
    nodes = model_tables.node_table(spark, tree)
    assert nodes.filter("categories IS NOT NULL").count() and nodes.filter("threshold IS NOT NULL").count()
    assert differing(tree, df, nodes) == 0
    faults = model_tables.node_faults(nodes, model_tables.descend(df.select("id", "scaledFeatures"), nodes, depth=4))
    assert faults.first().asDict() == {"hojas": 0, "sumas": 0, "impurezas": 0, "ganancias": 0}
    wrong = nodes.withColumn("counts", F.transform("counts", lambda c: c + F.col("node")))
    assert model_tables.node_faults(wrong, model_tables.descend(df.select("id", "scaledFeatures"), nodes, depth=4)).first()["sumas"] > 0
    monkeypatch.setattr(model_tables, "BROADCAST_NODES", 0)
    assert differing(tree, df, nodes, depth=4) == 0


def test_forest_votes(spark):
    df = frame(spark).cache()
    forest = RandomForestClassifier(featuresCol="scaledFeatures", numTrees=7, maxDepth=4, seed=3).fit(df)
    assert differing(forest, df, model_tables.node_table(spark, forest), depth=4) == 0


def test_a_tree_of_one_leaf_and_no_rows(spark):
    df = frame(spark, 30).withColumn("label", F.lit(1.0)).cache()
    tree = DecisionTreeClassifier(featuresCol="scaledFeatures", seed=1).fit(df)
    nodes = model_tables.node_table(spark, tree)
    assert nodes.count() == 1 and differing(tree, df, nodes) == 0
    assert model_tables.predict_by_nodes(df.limit(0), nodes, ["id"], "ours").count() == 0


def test_linear_margins(spark):
    df = frame(spark).cache()
    model = LogisticRegression(featuresCol="scaledFeatures", family="multinomial", maxIter=10).fit(df)
    ours = model.transform(df).withColumn("ours", model_tables.predict_by_weights(model_tables.weight_rows(model)))
    assert ours.filter("prediction <> ours").count() == 0
