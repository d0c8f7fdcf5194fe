"""Global ranks and exact quantiles without a single-task sort.

A global ``percent_rank`` window pulls all rows into one task, and the exact ``percentile`` aggregate keeps all
distinct values of a group in one buffer. Here approximate quantiles cut the value range into buckets of similar
size, bucket totals give each bucket its offset, and only ranks inside a bucket need a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlore.operators.skew import hot_keys, split_join
from gridlore.session import materialize

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 10_000
PROBES_PER_BUCKET = 100
MIN_PROBES = 100_000


def _cut_points(df: DataFrame, value: str) -> list[float]:
    """Bucket borders: at most MAX_BUCKETS numbers reach the driver.

    Borders need not be exact, so a probe of a long frame is enough to place them, as for a range partitioning; all
    rows are then counted and ranked in the buckets.
    """
    rows = df.count()
    n = min(MAX_BUCKETS, max(8, rows // ROWS_PER_BUCKET))
    probes = max(MIN_PROBES, n * PROBES_PER_BUCKET)
    probe = df.sample(probes / rows, seed=1) if rows > probes else df
    cuts = probe.approxQuantile(value, [i / n for i in range(1, n)], 0.25 / n)
    finite = sorted({c for c in cuts if abs(c) != float("inf")}) or [0.0]
    return [float("-inf"), *finite, float("inf")]


def _with_bucket(df: DataFrame, value: str) -> DataFrame:
    """Adds ``_b``: non-decreasing in ``value`` under Spark's order (null first, NaN last)."""
    df = df.withColumn("_d", F.col(value).cast("double"))
    cut = Bucketizer(splits=_cut_points(df, "_d"), inputCol="_d", outputCol="_bd", handleInvalid="keep")
    known = cut.transform(df.withColumns({"_null": F.col("_d").isNull(), "_d": F.coalesce("_d", F.lit(0.0))}))
    bucket = F.when(F.col("_null"), -1).otherwise(F.col("_bd").cast("int"))
    return known.withColumn("_b", bucket).drop("_d", "_bd", "_null")


def _before(order: Sequence[str], by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value: ``n`` (rows with it), ``below`` (rows strictly below), ``total``."""
    by = list(by)
    counts = materialize(df.groupBy(*by, value).agg(F.count("*").alias("n")), "value-counts")
    cells = _with_bucket(counts, value)
    totals = cells.groupBy(*by, "_b").agg(F.sum("n").alias("_n"))
    # at most MAX_BUCKETS + 2 rows per group in this window
    offsets = totals.select(
        *by, "_b",
        F.coalesce(F.sum("_n").over(_before(["_b"], by or [F.lit(0)])), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*(by or [F.lit(0)]))).alias("total"))
    inside = F.coalesce(F.sum("n").over(_before([value], [*by, "_b"])), F.lit(0))
    return (_null_safe_join(cells, offsets, [*by, "_b"])
            .withColumn("below", F.col("_offset") + inside)
            .select(*by, value, "n", "below", "total"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def percent_rank(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds SQL ``percent_rank`` over ``value``; a value shared by very many rows is split over tasks."""
    by = list(by)
    ranks = materialize(value_ranks(df, value, by), "value-ranks")
    rows = ranks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = hot_keys(ranks.select(*by, value, "n").na.drop(), [*by, value], "n", rows)
    pr = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    lookup = ranks.select(*by, value, pr.alias(out))
    no_null = [F.col(c).isNotNull() for c in [*by, value]]
    whole = no_null[0]
    for condition in no_null[1:]:
        whole = whole & condition
    spread = [c for c, t in df.dtypes if not t.startswith("map")]
    main = split_join(df.filter(whole), lookup, [*by, value], hot, spread)
    rest = _null_safe_join(df.filter(~whole), lookup.filter(~whole), [*by, value])
    return main.unionByName(rest).select(*df.columns, out)


def positions(df: DataFrame, value: str, out: str) -> DataFrame:
    """0-based position of each row by a unique numeric ``value``, without a global window."""
    ranks = value_ranks(df.select(value), value)
    return df.join(ranks.select(value, F.col("below").alias(out)), value)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    interpolate: bool = False) -> DataFrame:
    """Exact quantiles, long form: ``by..., prob, quantile``. Nulls and NaN are left out.

    ``interpolate`` gives the linear-interpolation quantile, otherwise the least value whose cumulative share
    reaches the probability. Rows are only counted per bucket; values are shuffled from the buckets that hold
    a wanted position, not from the rest.
    """
    by = list(by)
    keys = by or [F.lit(0)]
    data = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    cells = _with_bucket(data, "_v")
    totals = cells.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    offsets = totals.select(
        *by, "_b", "_n",
        F.coalesce(F.sum("_n").over(_before(["_b"], keys)), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))
    wanted = offsets.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    if interpolate:
        exact = F.col("prob") * (F.col("_total") - 1)
        wanted = (wanted.withColumn("_frac", exact - F.floor(exact))
                  .withColumn("_pos", F.explode(F.array_distinct(F.array(F.floor(exact) + 1, F.ceil(exact) + 1)))))
    else:
        wanted = (wanted.withColumn("_frac", F.lit(0.0))
                  .withColumn("_pos", F.greatest(F.ceil(F.col("prob") * F.col("_total")), F.lit(1))))
    wanted = (wanted.filter((F.col("_pos") > F.col("_offset")) & (F.col("_pos") <= F.col("_offset") + F.col("_n")))
              .select(*by, "_b", "prob", "_frac", "_pos", "_offset"))
    wanted = materialize(wanted, "quantile-targets")
    inside = _null_safe_join(cells, wanted.select(*by, "_b").distinct(), [*by, "_b"], "left_semi")
    values = inside.groupBy(*by, "_b", "_v").agg(F.count("*").alias("_n"))
    values = values.withColumn("_low", F.coalesce(F.sum("_n").over(_before(["_v"], [*by, "_b"])), F.lit(0)))
    found = (_null_safe_join(values, wanted, [*by, "_b"])
             .filter((F.col("_pos") > F.col("_offset") + F.col("_low"))
                     & (F.col("_pos") <= F.col("_offset") + F.col("_low") + F.col("_n"))))
    low, high = F.min("_v"), F.max("_v")
    return found.groupBy(*by, "prob").agg((low + (high - low) * F.max("_frac")).alias("quantile"))


def exact_quantiles_wide(df: DataFrame, value: str, named: dict[str, float], by: Sequence[str] = (),
                         interpolate: bool = False) -> DataFrame:
    """One column per probability; one row per group, or a single row (of nulls for empty input)."""
    long = exact_quantiles(df, value, sorted(set(named.values())), by, interpolate)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for name, p in named.items()])
