"""Fitted classifiers as tables: node tables scored by relational descent, linear models by their weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegressionModel, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.session import materialize, new_path

#: Node tables up to so many rows are broadcast (about 100 bytes a row); larger ones are joined by shuffle.
BROADCAST_NODES = 200_000
_NODE = ["tree", "node", "feature", "threshold", "categories", "low", "high", "counts", "rows", "impurity", "gain"]


def node_table(spark, model) -> DataFrame:
    """One row per node of a decision tree or a forest, read from the model as saved in the shared folder.

    ``tree, node``; an inner node has ``feature`` and ``threshold`` (at most that: child ``low``, else ``high``) or
    ``categories`` (those go low); a leaf has null in these. ``counts`` are class weights, ``rows`` the training rows that came by.
    """
    path = new_path(spark, "trees")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    stored = (stored.select(F.lit(0).alias("tree"), "*") if "nodeData" not in stored.columns
              else stored.select(F.col("treeID").alias("tree"), "nodeData.*"))
    inner, values = F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")
    continuous = F.col("split.numCategories") < 0
    return stored.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, values[0]).alias("threshold"), F.when(inner & ~continuous, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("low"), F.when(inner, F.col("rightChild")).alias("high"),
        F.col("impurityStats").alias("counts"), F.col("rawCount").alias("rows"), "impurity", F.when(inner, F.col("gain")).alias("gain"))


def tree_depth(nodes: DataFrame) -> int:
    """Levels below the root of the deepest tree, level by level."""
    links = nodes.filter("feature IS NOT NULL").select("tree", F.col("node").alias("_up"), F.explode(F.array("low", "high")).alias("node"))
    level, depth = nodes.filter("node = 0").select("tree", "node"), 0
    while True:
        level = materialize(level.withColumnRenamed("node", "_up").join(links, ["tree", "_up"]).select("tree", "node"), "level")
        if level.isEmpty():
            return depth
        depth += 1


def descend(df: DataFrame, nodes: DataFrame, features: str = "scaledFeatures", depth: int | None = None) -> DataFrame:
    """Every row of ``df`` once per tree, with the columns ``tree, leaf, counts`` of the leaf it reaches.

    One join per level: rows that have reached a leaf stay there. ``depth`` is the deepest tree's, found out unless
    given. ``df`` is not shuffled while the node table is small enough to be broadcast.
    """
    own = nodes.select(*[F.col(c).alias(f"_n_{c}") for c in _NODE])
    size = nodes.count()
    small = size <= BROADCAST_NODES
    depth = tree_depth(nodes) if depth is None else depth
    trees = nodes.groupBy("tree").count().select("tree")
    at = df.withColumn("_x", vector_to_array(F.col(features))).join(F.broadcast(trees) if small else trees, F.lit(True)).withColumn("_at", F.lit(0))
    for _ in range(depth):
        met = at.join(F.broadcast(own) if small else own, (F.col("tree") == F.col("_n_tree")) & (F.col("_at") == F.col("_n_node")))
        value = F.get("_x", F.col("_n_feature"))
        low = F.when(F.col("_n_categories").isNull(), value <= F.col("_n_threshold")).otherwise(F.array_contains("_n_categories", value))
        step = F.when(F.col("_n_feature").isNull(), F.col("_at")).when(low, F.col("_n_low")).otherwise(F.col("_n_high"))
        at = met.select(*df.columns, "_x", "tree", step.alias("_at"))
    leaf = at.join(F.broadcast(own) if small else own, (F.col("tree") == F.col("_n_tree")) & (F.col("_at") == F.col("_n_node")))
    return leaf.select(*df.columns, "tree", F.col("_at").alias("leaf"), F.col("_n_counts").alias("counts"))


def _first_most(values: Column) -> Column:
    """Place of the greatest value, the first of equals, as a class label."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def predict_by_nodes(df: DataFrame, nodes: DataFrame, keys: Sequence[str], out: str, features: str = "scaledFeatures",
                     depth: int | None = None) -> DataFrame:
    """``keys`` and the class that the trees' leaves vote for, each tree with its leaf's class shares. ``keys`` name a row."""
    placed = descend(df.select(*keys, features), nodes, features, depth)
    total = F.aggregate("counts", F.lit(0.0), lambda a, b: a + b)
    shares = placed.select(*keys, "tree", F.transform("counts", lambda c: c / F.when(total > 0, total).otherwise(1.0)).alias("shares"))
    votes = shares.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("tree", "shares"))).alias("v"))
    summed = F.aggregate(F.slice("v", 2, F.size("v")), F.element_at("v", 1)["shares"],
                         lambda a, t: F.zip_with(a, t["shares"], lambda x, y: x + y))
    return votes.select(*keys, _first_most(summed).alias(out))


def weight_rows(model) -> list[tuple[float, list[float]]]:
    """Intercept and weights of every class of a multinomial logistic or one-vs-rest linear model."""
    if isinstance(model, OneVsRestModel):
        return [(float(m.intercept), [float(w) for w in m.coefficients]) for m in model.models]
    if isinstance(model, LogisticRegressionModel):
        return [(float(b), [float(w) for w in row]) for b, row in zip(model.interceptVector, model.coefficientMatrix.toArray())]
    raise TypeError(f"no class weights in {type(model).__name__}")


def predict_by_weights(weights: Sequence[tuple[float, Sequence[float]]], features: str = "scaledFeatures") -> Column:
    """The class of the greatest margin, the first of equals, as one expression."""
    x = vector_to_array(F.col(features))

    def margin(intercept, row):
        products = F.zip_with(x, F.array(*[F.lit(w) for w in row]), lambda a, w: a * w)
        return F.aggregate(products, F.lit(0.0), lambda a, b: a + b) + F.lit(intercept)

    return _first_most(F.array(*[margin(b, row) for b, row in weights]))


def node_faults(nodes: DataFrame, placed: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """One row of counts that are 0 for a sound node table of Gini trees; ``placed`` are the training rows after ``descend``.

    ``hojas``: leaves whose ``rows`` are not those that land there. ``sumas``: inner nodes whose class counts are not their
    children's. ``impurezas`` and ``ganancias``: nodes whose impurity or gain does not follow from the class counts.
    """
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    gini = lambda c: 1.0 - F.aggregate(c, F.lit(0.0), lambda a, b: a + (b / total(c)) * (b / total(c)))
    landed = placed.groupBy("tree", F.col("leaf").alias("node")).agg(F.count("*").alias("landed"))
    side = lambda name: nodes.select(F.col("tree").alias(f"{name}_tree"), F.col("node").alias(f"{name}_node"), F.col("counts").alias(f"{name}_c"))
    both = nodes.join(landed, ["tree", "node"], "left")
    for name in ("low", "high"):
        both = both.join(side(name), (F.col("tree") == F.col(f"{name}_tree")) & (F.col(name) == F.col(f"{name}_node")), "left")
    inner, c, a, b = F.col("feature").isNotNull(), F.col("counts"), F.col("low_c"), F.col("high_c")
    summed = F.zip_with(a, b, lambda x, y: x + y)
    gain = gini(c) - total(a) / total(c) * gini(a) - total(b) / total(c) * gini(b)
    off = lambda x, y: F.abs(x - y) > tolerance
    return both.agg(
        F.count_if(~inner & (F.coalesce("landed", F.lit(0)) != F.col("rows"))).alias("hojas"),
        F.count_if(inner & F.exists(F.zip_with(summed, c, lambda x, y: off(x, y)), lambda x: x)).alias("sumas"),
        F.count_if(off(gini(c), F.col("impurity"))).alias("impurezas"),
        F.count_if(inner & off(gain, F.col("gain"))).alias("ganancias"))
