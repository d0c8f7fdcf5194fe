"""Mergeable states of statistics kept beside a stored table: moments, co-moments and quantile sketches by partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlore.operators.merge import partitions_of, replace_partitions

#: Size of a quantile sketch: its error in rank is about 0.4 % (0.3 % for a single quantile).
SKETCH_K = 800


def moment_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys, x, y, n, mean_x, mean_y, m2_x, m2_y, m3, c, low, high`` for every pair of ``columns``, each with itself too.

    A column's own row (``x = y``) is over its non-null values: ``m2`` and ``m3`` are sums of powers of deviations. A row of two columns is over
    the rows complete in all ``columns``; ``c`` sums products of deviations. One aggregate, however many columns.
    """
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    cells = []
    for i, (x, y) in enumerate(combinations_with_replacement(columns, 2)):
        a, b = (F.col(c).cast("double") if x == y else F.when(complete, F.col(c).cast("double")) for c in (x, y))
        n = F.count(a)
        m2 = F.coalesce(F.var_pop(a) * n, F.lit(0.0))
        alone = x == y
        m3 = F.coalesce(F.skewness(a) * F.sqrt(m2 * m2 * m2 / n), F.lit(0.0)) if alone else F.lit(None).cast("double")
        cells.append(F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), n.alias("n"), F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"), m2.alias("m2_x"),
            (m2 if alone else F.coalesce(F.var_pop(b) * n, F.lit(0.0))).alias("m2_y"), m3.alias("m3"),
            (m2 if alone else F.coalesce(F.covar_pop(a, b) * n, F.lit(0.0))).alias("c"), F.min(a).alias("low"), F.max(a).alias("high")).alias(f"_{i}"))
    wide = df.groupBy(*keys).agg(*cells)
    return wide.select(*keys, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cells))])))


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The states of all rows that share ``keys``, whatever parts they were taken over.

    Deviations are shifted from each part's mean to the common one: with d the difference of means, m2 gains n d^2, m3 gains
    3 d m2 + n d^3 and c gains n d_x d_y. States are few and small; one shuffle by key serves both the means and the sums.
    """
    every = [*keys, "x", "y"]
    own = Window.partitionBy(*every)
    live = states.filter("n > 0")
    shifted = live.withColumns({f"_d{s}": F.col(f"mean_{s}") - F.sum(F.col("n") * F.col(f"mean_{s}")).over(own) / F.sum("n").over(own) for s in "xy"})
    n, dx, dy = F.col("n"), F.col("_dx"), F.col("_dy")
    return shifted.groupBy(*every).agg(
        F.sum("n").alias("n"), (F.sum(n * F.col("mean_x")) / F.sum("n")).alias("mean_x"), (F.sum(n * F.col("mean_y")) / F.sum("n")).alias("mean_y"),
        F.sum(F.col("m2_x") + n * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + n * dy * dy).alias("m2_y"),
        F.sum(F.col("m3") + 3 * dx * F.col("m2_x") + n * dx * dx * dx).alias("m3"),
        F.sum(F.col("c") + n * dx * dy).alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))


def describe_states(states: DataFrame, keys: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """``keys, variable, n, media, desviacion, minimo, maximo, skewness``; the last null where there is no spread."""
    own = merge_states(states.filter("x = y"), keys)
    spread = F.col("m2_x") / F.col("n")
    return own.select(
        *keys, F.col("x").alias("variable"), "n", F.round("mean_x", digits).alias("media"),
        F.round(F.when(F.col("n") > 1, F.sqrt(F.col("m2_x") / (F.col("n") - 1))), digits).alias("desviacion"),
        F.round("low", digits).alias("minimo"), F.round("high", digits).alias("maximo"),
        F.round(F.when(spread > 0, F.col("m3") / F.col("n") / (spread * F.sqrt(spread))), 4).alias("skewness"))


def correlate_states(states: DataFrame, keys: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Pearson matrix ``keys, fila, columna, valor`` in long form, both triangles; the diagonal is 1 where there is spread."""
    r = F.when((F.col("m2_x") > 0) & (F.col("m2_y") > 0), F.col("c") / F.sqrt(F.col("m2_x") * F.col("m2_y")))
    cells = merge_states(states, keys).select(*keys, "x", "y", F.round(r, digits).alias("valor"))
    both = cells.unionByName(cells.filter("x <> y").withColumnsRenamed({"x": "_y", "y": "x"}).withColumnRenamed("_y", "y"))
    return both.withColumnsRenamed({"x": "fila", "y": "columna"})


def sketch_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``keys, variable, sketch``: a quantile sketch of every column's non-null values; none where there are none."""
    wide = df.groupBy(*keys).agg(*[F.when(F.count(c) > 0, F.kll_sketch_agg_double(F.col(c).cast("double"), k)).alias(c) for c in columns])
    long = wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("sketch")) for c in columns])))
    return long.filter(F.col("sketch").isNotNull())


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``keys, variable, n, p, valor``: quantiles of all values behind the sketches that share ``keys``, merged first."""
    merged = sketches.groupBy(*keys, "variable").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    answers = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("valor"))
                        for p in probabilities])
    return merged.select(*keys, "variable", F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(answers))


def rank_errors(df: DataFrame, quantiles: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``error``: how far each answer's true rank is from ``p``; 0 where ``p`` lies within the ranks of its equals.

    One pass over ``df``: the answers, a row for each key, variable and ``p``, are few and joined to its rows.
    """
    long = df.unpivot(list(keys), list(columns), "variable", "_x").filter(F.col("_x").isNotNull())
    met = quantiles.join(long, [*keys, "variable"])
    ranks = met.groupBy(*keys, "variable", "n", "p", "valor").agg(
        (F.count_if(F.col("_x") < F.col("valor")) / F.count("*")).alias("_below"), (F.count_if(F.col("_x") <= F.col("valor")) / F.count("*")).alias("_upto"))
    return ranks.select(*keys, "variable", "n", "p", "valor", F.greatest(F.col("_below") - F.col("p"), F.col("p") - F.col("_upto"), F.lit(0.0)).alias("error"))


def refresh_states(spark: SparkSession, table: str, states: str, partition_by: Sequence[str], build: Callable[[DataFrame], DataFrame],
                   touched: DataFrame | None = None, schema: StructType | None = None) -> None:
    """Takes the states of a stored table's partitions anew and replaces them in the table of states.

    ``build`` makes the states of some partitions' rows and keeps the columns ``partition_by``, by which both tables are stored.
    ``touched`` are rows of the partitions that have changed, such as the source of an upsert: no other is read or written.
    Without it all are. A repeated refresh gives the same states.
    """
    read = spark.read if schema is None else spark.read.schema(schema)
    rows = read.parquet(table)
    if touched is not None:
        rows = partitions_of(rows, touched, partition_by)
    replace_partitions(build(rows), states, partition_by)
