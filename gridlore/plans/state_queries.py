"""Statistics from states kept beside a stored table over two loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlore.operators import merge, states
from gridlore.plans.inputs import table
from gridlore.plans.registry import query
from gridlore.session import new_path

COLUMNS = ["valor", "dia", "cliente"]
PARTITION, GROUP, KEY = ["periodo"], ["categoria"], "registro"
PROBABILITIES = [0.01, 0.25, 0.5, 0.75, 0.99]
#: Rank error the sketches must keep.
ERROR = 0.01


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("registro"), F.year("o_orderdate").alias("periodo"), F.col("o_orderpriority").alias("categoria"),
        F.col("o_totalprice").alias("valor"), F.when(F.col("o_orderkey") % 10 != 0, F.dayofyear("o_orderdate")).cast("double").alias("dia"),
        F.col("o_custkey").cast("double").alias("cliente"))


_ORDERS_SQL = """
WITH orders_ AS (SELECT o_orderpriority AS categoria, CAST(year(o_orderdate) AS INTEGER) AS periodo, o_totalprice AS valor,
                        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(dayofyear(o_orderdate) AS DOUBLE) END AS dia,
                        CAST(o_custkey AS DOUBLE) AS cliente FROM orders),"""


def _two_loads(spark, folder, build):
    """A stored table and its states: first all orders with later years' values doubled, then these years again as they are."""
    path, kept = new_path(spark, "kept-table"), new_path(spark, "kept-states")
    rows = _orders(spark, folder)
    late = F.col("periodo") >= 1997
    first = rows.withColumn("valor", F.when(late, F.col("valor") * 2).otherwise(F.col("valor")))
    second = rows.filter(late)
    for source, touched in ((first, None), (second, second)):
        merge.upsert_table(path, source, KEY, PARTITION, schema=rows.schema)
        states.refresh_states(spark, path, kept, PARTITION, build, touched, rows.schema)
    return spark.read.schema(rows.schema).parquet(path), spark.read.parquet(kept)


def _moments(rows):
    return states.moment_states(rows, [*PARTITION, *GROUP], COLUMNS)


def _sketches(rows):
    return states.sketch_states(rows, [*PARTITION, *GROUP], COLUMNS)


@query("moments_kept_describe", f"""{_ORDERS_SQL}
long AS ({' UNION ALL '.join(f"SELECT categoria, '{c}' AS variable, {c} AS x FROM orders_ WHERE {c} IS NOT NULL" for c in COLUMNS)}),
means AS (SELECT categoria, variable, avg(x) AS m FROM long GROUP BY ALL),
powers AS (SELECT l.categoria, l.variable, count(*) AS n, any_value(m) AS m, sum((x - m) * (x - m)) AS m2, sum((x - m) * (x - m) * (x - m)) AS m3,
                  min(x) AS low, max(x) AS high FROM long l JOIN means USING (categoria, variable) GROUP BY ALL)
SELECT categoria, variable, n, round(m, 4) AS media, round(sqrt(m2 / (n - 1)), 4) AS desviacion, round(low, 4) AS minimo, round(high, 4) AS maximo,
       round(m3 / n / pow(m2 / n, 1.5), 4) AS skewness FROM powers""")
def moments_kept_describe(spark, folder):
    """Descriptions by category from the kept moments, after a second load that changed some years only."""
    _, kept = _two_loads(spark, folder, _moments)
    return states.describe_states(kept, GROUP, digits=4)


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)


_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{x}' AS fila, '{y}' AS columna, round({'CAST(1 AS DOUBLE)' if x == y else f'corr({x}, {y})'}, 6) AS valor FROM "
    f"{'(SELECT 1) one' if x == y else 'complete'}" for x in COLUMNS for y in COLUMNS)


@query("moments_kept_corr", f"{_ORDERS_SQL} complete AS (SELECT * FROM orders_ WHERE {_COMPLETE}) {_CORR_SQL}")
def moments_kept_corr(spark, folder):
    """Pearson matrix of all years and categories from the kept co-moments."""
    _, kept = _two_loads(spark, folder, _moments)
    return states.correlate_states(kept)


def _checked_sketches(spark, folder, keys):
    rows, kept = _two_loads(spark, folder, _sketches)
    answers = states.sketch_quantiles(kept, PROBABILITIES, keys)
    found = states.rank_errors(rows, answers, keys, COLUMNS)
    return found.select(*keys, "variable", "n", "p", (F.col("error") <= ERROR).alias("dentro"))


def _sketch_sql(keys):
    named = "".join(f"{k}, " for k in keys)
    long = " UNION ALL ".join(f"SELECT {named}'{c}' AS variable, count({c}) AS n FROM orders_ GROUP BY ALL" for c in COLUMNS)
    return f"""{_ORDERS_SQL} counts AS ({long})
SELECT {named}variable, n, CAST(p AS DOUBLE) AS p, true AS dentro FROM counts, (VALUES {', '.join(f'({p})' for p in PROBABILITIES)}) v(p)"""


@query("sketch_quantiles_by_category", _sketch_sql(GROUP))
def sketch_quantiles_by_category(spark, folder):
    """Quantiles from kept sketches, merged over years: whether each answer's true rank is within 0.01 of the asked one, always true."""
    return _checked_sketches(spark, folder, GROUP)


@query("sketch_quantiles_by_year", _sketch_sql(PARTITION))
def sketch_quantiles_by_year(spark, folder):
    """The same sketches merged over categories."""
    return _checked_sketches(spark, folder, PARTITION)
