"""Reports, distributions, correlations, ranks, order and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlore.functions.rows import one_row
from gridlore.functions.text import first_token
from gridlore.operators import profiles, ranks, sampling, stats
from gridlore.operators.cleaning import normalize
from gridlore.operators.modeling import simple_regression
from gridlore.plans import inputs
from gridlore.plans.inputs import FACTS_SQL, PROFILE_SQL, table
from gridlore.plans.registry import query
from gridlore.session import materialize

FEATURES = profiles.FEATURES


def _items(spark, folder):
    """Orders as a price list: item, value, category, group, capture time."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("item"), F.col("o_totalprice").alias("valor"),
        F.col("o_orderpriority").alias("categoria"), F.col("o_orderstatus").alias("grupo"),
        F.col("o_orderdate").cast("string").alias("fecha_captura"))


@query("coll_count", "SELECT count(*) AS documentos FROM events")
def coll_count(spark, folder):
    return table(spark, folder, "events").agg(F.count("*").alias("documentos"))


@query("coll_preview", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def coll_preview(spark, folder):
    """First documents without their free-form field."""
    return table(spark, folder, "events").drop("props", "ts").orderBy("event_id").limit(10)


@query("group_counts", f"""
WITH {FACTS_SQL} SELECT integrante, dataset, count(*) AS registros FROM facts GROUP BY ALL""")
def group_counts(spark, folder):
    return stats.group_counts(inputs.facts(spark, folder), ["integrante", "dataset"])


@query("category_report", """
SELECT o_orderpriority AS categoria, count(*) AS cantidad, round(avg(o_totalprice), 4) AS precio_promedio,
       min(o_totalprice) AS precio_minimo, max(o_totalprice) AS precio_maximo FROM orders GROUP BY 1""")
def category_report(spark, folder):
    return stats.category_report(_items(spark, folder), digits=4)


@query("group_ticket", """
SELECT o_orderpriority AS categoria, count(*) AS total, round(avg(o_totalprice), 4) AS precio_medio,
       max(CAST(o_orderdate AS VARCHAR)) AS ultima_sincronizacion FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def group_ticket(spark, folder):
    return stats.group_ticket(_items(spark, folder), "F", digits=4)


@query("brand_avg_price", """
SELECT split_part(p_name, ' ', 1) AS marca, round(avg(p_retailprice), 6) AS precio_promedio
FROM part WHERE p_retailprice > 950 GROUP BY 1""")
def brand_avg_price(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_name").alias("identificador"), F.col("p_retailprice").alias("valor"))
    return stats.brand_report(parts, first_token("identificador"), 950.0)


_SUMMARY_ROWS = "count(*) AS registros, round(avg(valor), 6) AS promedio, max(valor) AS maximo"
_SUMMARY = "count(valor) AS registros, round(avg(valor), 6) AS promedio, max(valor) AS maximo"


@query("summary_category", f"""
WITH {FACTS_SQL} SELECT pais, categoria_energia, indicador, {_SUMMARY_ROWS} FROM facts GROUP BY ALL""")
def summary_category(spark, folder):
    keys = ["pais", "categoria_energia", "indicador"]
    return stats.value_summary(inputs.facts(spark, folder), keys, [F.desc("registros"), F.desc("maximo"), *keys], all_rows=True)


@query("summary_dataset", f"WITH {FACTS_SQL} SELECT integrante, dataset, {_SUMMARY} FROM facts GROUP BY ALL")
def summary_dataset(spark, folder):
    return stats.value_summary(inputs.facts(spark, folder), ["integrante", "dataset"],
                               [F.asc("integrante"), F.desc("registros"), F.asc("dataset")])


@query("summary_indicator_top", f"""
WITH {FACTS_SQL} SELECT pais, indicador, categoria_energia, {_SUMMARY} FROM facts GROUP BY ALL
ORDER BY registros DESC, pais, indicador, categoria_energia LIMIT 20""")
def summary_indicator_top(spark, folder):
    keys = ["pais", "indicador", "categoria_energia"]
    return stats.value_summary(inputs.facts(spark, folder), keys, [F.desc("registros"), *keys], limit=20)


@query("group_struct_flatten", f"""
WITH {FACTS_SQL} SELECT integrante, dataset, count(*) AS registros, max(valor) AS valor_maximo FROM facts GROUP BY ALL""")
def group_struct_flatten(spark, folder):
    return stats.grouped_struct(inputs.facts(spark, folder), ["integrante", "dataset"])


_NULLABLE = ["tema", "categoria_energia", "region", "actor", "valor"]


@query("null_profile", f"""
WITH {inputs.NORMAL_SQL} SELECT {', '.join(f'count(*) - count({c}) AS {c}' for c in _NULLABLE)} FROM normal""")
def null_profile(spark, folder):
    return stats.null_profile(normalize(inputs.facts(spark, folder), _NULLABLE))


def _long_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS x FROM {source}" for c in columns)


@query("describe_features", f"""
WITH {PROFILE_SQL} SELECT variable, count(x) AS n, round(avg(x), 6) AS media, round(stddev_samp(x), 6) AS desviacion,
       round(min(x), 6) AS minimo, round(max(x), 6) AS maximo FROM ({_long_sql(FEATURES, 'profile')}) t GROUP BY 1""")
def describe_features(spark, folder):
    return stats.describe(inputs.profile(spark, folder), FEATURES)


_MEASURED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_quartiles", f"""
SELECT variable, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
       round(quantile_cont(x, 0.75), 6) AS q75 FROM ({_long_sql(_MEASURED, 'lineitem')}) t GROUP BY 1""")
def describe_quartiles(spark, folder):
    return stats.quartiles(table(spark, folder, "lineitem").select(*_MEASURED), _MEASURED)


@query("skew_by_category", """
SELECT o_orderpriority, n AS observaciones, round(m, 6) AS media,
       round((s3 / n - 3 * m * s2 / n + 2 * m * m * m) / pow(s2 / n - m * m, 1.5), 4) AS skewness
FROM (SELECT o_orderpriority, count(*) AS n, avg(x) AS m, sum(x * x) AS s2, sum(x * x * x) AS s3
      FROM (SELECT o_orderpriority, o_totalprice AS x FROM orders) t GROUP BY 1) u""")
def skew_by_category(spark, folder):
    return stats.skew_by(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice")


@query("quartiles_exact", """
SELECT quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.75) AS q3 FROM lineitem""")
def quartiles_exact(spark, folder):
    return ranks.exact_quantiles_wide(table(spark, folder, "lineitem"), "l_extendedprice", {"q1": 0.25, "q3": 0.75})


@query("quartiles_approx")
def quartiles_approx(spark, folder):
    return profiles.iqr_bounds(table(spark, folder, "lineitem"), "l_extendedprice", relative_error=0.01)


_IQR_SQL = f"""{PROFILE_SQL},
bounds AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
           FROM (SELECT quantile_disc(intensidad_co2, 0.25) AS q1, quantile_disc(intensidad_co2, 0.75) AS q3 FROM profile) t)"""


@query("iqr_outliers", f"""
WITH {_IQR_SQL} SELECT periodo, region, categoria_energia, round(intensidad_co2, 9) AS intensidad_co2,
       intensidad_co2 < lower OR intensidad_co2 > upper AS es_outlier_intensidad FROM profile, bounds""")
def iqr_outliers(spark, folder):
    flagged = profiles.flag_outliers(inputs.stored_profile(spark, folder), "intensidad_co2", "es_outlier_intensidad")
    return flagged.select(*profiles.PROFILE_KEY, F.round("intensidad_co2", 9).alias("intensidad_co2"),
                          "es_outlier_intensidad")


@query("iqr_counts", f"""
WITH {_IQR_SQL} SELECT intensidad_co2 < lower OR intensidad_co2 > upper AS es_outlier_intensidad, count(*) AS registros,
       round(min(lower), 9) AS inferior, round(max(upper), 9) AS superior FROM profile, bounds GROUP BY 1""")
def iqr_counts(spark, folder):
    stored = inputs.stored_profile(spark, folder)
    bounds = one_row(profiles.iqr_bounds(stored, "intensidad_co2"))
    counted = (profiles.flag_outliers(stored, "intensidad_co2", "es_outlier_intensidad")
               .groupBy("es_outlier_intensidad").agg(F.count("*").alias("registros")))
    return counted.withColumns({"inferior": F.round(bounds["lower"], 9), "superior": F.round(bounds["upper"], 9)})


@query("zscore", """
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z
FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders) t""")
def zscore(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return profiles.add_zscore(rows, "o_totalprice", "z").select("o_orderkey", F.round("z", 6).alias("z"))


def _matrix_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS fila, '{b}' AS columna, round(corr({a}, {b}), 6) AS valor FROM {source}"
                              for a in columns for b in columns)


@query("corr_pearson", f"WITH {PROFILE_SQL} {_matrix_sql(FEATURES, 'profile')}")
def corr_pearson(spark, folder):
    return stats.correlation(inputs.profile(spark, folder), FEATURES)


@query("corr_spearman", f"""
WITH {PROFILE_SQL},
ranked AS (SELECT {', '.join(f'percent_rank() OVER (ORDER BY {c}) AS {c}' for c in FEATURES)} FROM profile)
{_matrix_sql(FEATURES, 'ranked')}""")
def corr_spearman(spark, folder):
    return stats.rank_correlation(inputs.stored_profile(spark, folder), FEATURES, profiles.PROFILE_KEY)


@query("corr_spearman_lines", f"""
WITH ranked AS (SELECT {', '.join(f'percent_rank() OVER (ORDER BY {c}) AS {c}' for c in _MEASURED)} FROM lineitem)
{_matrix_sql(_MEASURED, 'ranked')}""")
def corr_spearman_lines(spark, folder):
    """Over all order lines. A line has no unique key, so each gets a number, stored with it."""
    rows = table(spark, folder, "lineitem").select(*_MEASURED, F.monotonically_increasing_id().alias("_id"))
    return stats.rank_correlation(materialize(rows, "spearman-rows"), _MEASURED, ["_id"])


@query("percent_rank_global", """
SELECT l_orderkey, l_linenumber, l_extendedprice, round(percent_rank() OVER (ORDER BY l_extendedprice), 9) AS pr FROM lineitem""")
def percent_rank_global(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranks.percent_rank(rows, "l_extendedprice", "pr").withColumn("pr", F.round("pr", 9))


@query("percent_rank_ties", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
       round(percent_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 9) AS pr FROM lineitem""")
def percent_rank_ties(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return ranks.percent_rank(rows, "l_quantity", "pr", ["l_returnflag"]).withColumn("pr", F.round("pr", 9))


@query("confusion_pivot", """
SELECT quality, CAST(count(*) FILTER (toxic = 0) AS BIGINT) AS "0", CAST(count(*) FILTER (toxic = 1) AS BIGINT) AS "1"
FROM labels GROUP BY 1""")
def confusion_pivot(spark, folder):
    return stats.confusion(table(spark, folder, "labels"), "quality", "toxic", [0, 1])


@query("accuracy_agg", "SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM labels")
def accuracy_agg(spark, folder):
    return stats.accuracy(table(spark, folder, "labels"), "quality", "toxic").select(F.round("accuracy", 9).alias("accuracy"))


@query("boxplot_stats", """
SELECT o_orderpriority, round(lo, 6) AS minimo, round(q1, 6) AS q1, round(q2, 6) AS mediana, round(q3, 6) AS q3,
       round(hi, 6) AS maximo, round(q1 - 1.5 * (q3 - q1), 6) AS bigote_inferior,
       round(q3 + 1.5 * (q3 - q1), 6) AS bigote_superior
FROM (SELECT o_orderpriority, min(o_totalprice) AS lo, max(o_totalprice) AS hi, quantile_cont(o_totalprice, 0.25) AS q1,
             quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1) t""")
def boxplot_stats(spark, folder):
    return stats.boxplot(table(spark, folder, "orders").select("o_orderpriority", "o_totalprice"),
                         "o_orderpriority", "o_totalprice")


@query("scatter_loglog", f"""
WITH {PROFILE_SQL} SELECT periodo, region, categoria_energia, round(log10(generacion_mwh), 9) AS log_x,
       round(log10(emisiones_co2_mt), 9) AS log_y FROM profile""")
def scatter_loglog(spark, folder):
    return stats.scatter_loglog(inputs.profile(spark, folder), "generacion_mwh", "emisiones_co2_mt", profiles.PROFILE_KEY)


@query("standard_scale", f"""
WITH {PROFILE_SQL}
SELECT periodo, region, categoria_energia,
       {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_z'
                  for c in profiles.MODEL_FEATURES)} FROM profile""")
def standard_scale(spark, folder):
    return stats.standard_scale(inputs.profile(spark, folder), profiles.MODEL_FEATURES, profiles.PROFILE_KEY)


@query("linreg_single", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS pendiente,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercepto,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def linreg_single(spark, folder):
    return simple_regression(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")


@query("sort_nulls_last", f"""
WITH {inputs.NORMAL_SQL} SELECT tema, indicador, region, periodo, item, valor FROM normal""")
def sort_nulls_last(spark, folder):
    columns = ["tema", "indicador", "region", "periodo", "item", "valor"]
    return normalize(inputs.facts(spark, folder), columns).select(*columns).orderBy(
        *[F.col(c).asc_nulls_last() for c in columns])


@query("top1_item", """
SELECT CAST(o_orderkey AS VARCHAR) AS item, o_totalprice AS valor, o_orderpriority AS categoria, o_orderstatus AS grupo,
       CAST(o_orderdate AS VARCHAR) AS fecha_captura FROM orders ORDER BY o_totalprice DESC, item LIMIT 1""")
def top1_item(spark, folder):
    return sampling.top_k(_items(spark, folder), [F.desc("valor"), F.asc("item")], 1)


@query("topk_global", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey LIMIT 20""")
def topk_global(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return sampling.top_k(rows, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey"], 20)


@query("topk_filtered", f"""
WITH {FACTS_SQL} SELECT pais, region, tecnologia, actor, valor, unidad, url_origen, fecha_extraccion FROM facts
WHERE indicador = 'emisiones_co2' AND region = 'NATION_3'
ORDER BY valor DESC, fecha_extraccion, actor, tecnologia, pais LIMIT 10""")
def topk_filtered(spark, folder):
    rows = inputs.facts(spark, folder).filter((F.col("indicador") == "emisiones_co2") & (F.col("region") == "NATION_3"))
    rows = rows.select("pais", "region", "tecnologia", "actor", "valor", "unidad", "url_origen", "fecha_extraccion")
    return sampling.top_k(rows, [F.desc("valor"), "fecha_extraccion", "actor", "tecnologia", "pais"], 10)


@query("sample_seeded", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '7')), o_orderkey LIMIT 10""")
def sample_seeded(spark, folder):
    return sampling.sample_n(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                             ["o_orderkey"], 10, 7)


@query("split_hash", """
SELECT CASE WHEN ('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), 1, 7))::INTEGER % 100 < 70
            THEN 'train' ELSE 'test' END AS parte,
       count(*) AS registros, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def split_hash(spark, folder):
    train, test = sampling.train_test_split(table(spark, folder, "orders"), ["o_orderkey"])
    both = train.withColumn("parte", F.lit("train")).unionByName(test.withColumn("parte", F.lit("test")))
    return both.groupBy("parte").agg(F.count("*").alias("registros"), F.round(F.sum("o_totalprice"), 2).alias("total"))
