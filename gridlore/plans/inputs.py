"""The fact model laid over the given tables.

Order lines stand for yearly generation (price) and emissions (quantity) of a supplier's nation and a part's
technology, orders for projects of a customer's nation. Some cells are dirtied by rule (signs, blanks, padding) so
that cleaning has work to do; ``FACTS_SQL`` states the same rows for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.functions.text import classify, item_label
from gridlore.operators.cleaning import analysis_facts, clean_facts
from gridlore.operators.profiles import profile_features
from gridlore.schema import FACT_COLUMNS
from gridlore.session import materialize, spread

# fixed values: technology named for each part type
TECHNOLOGY = {
    "ECONOMY": "Solar Thermal and Photovoltaic",
    "STANDARD": "Natural Gas",
    "PROMO": "Coal",
    "SMALL": "Pumped Storage",
    "MEDIUM": "Nuclear",
    "LARGE": "Wood and Wood Derived Fuels",
}


# what the profile needs of a fact; the other columns are not read for it
PROFILE_COLUMNS = ["dataset", "integrante", "region", "periodo", "indicador", "categoria_energia", "tecnologia",
                   "actor", "item", "valor"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def technology(p_type: str = "p_type"):
    out = None
    for kind, name in TECHNOLOGY.items():
        out = F.when(F.col(p_type) == kind, name) if out is None else out.when(F.col(p_type) == kind, name)
    return out


def _named_nations(rows: DataFrame, spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Adds country group and nation. Joined to the wide side one table at a time: every table joined to it is then
    a plain scan whose size is known, so the side Spark broadcasts is never the wide one."""
    return (rows.join(table(spark, folder, "nation"), F.col(key) == F.col("n_nationkey"))
            .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumnsRenamed({"r_name": "pais", "n_name": "region"}))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with nation, technology and category; the category is found once per part, not per line."""
    parts = table(spark, folder, "part").select("p_partkey", technology().alias("tecnologia")).withColumn(
        "categoria", classify("tecnologia"))
    rows = (spread(table(spark, folder, "lineitem").select(
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_shipdate"))
            .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey")))
    return _named_nations(rows, spark, folder, "s_nationkey").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.col("l_shipdate").cast("string").alias("fecha_extraccion"), F.year("l_shipdate").alias("periodo"),
        "pais", "region", F.col("s_name").alias("actor"), "tecnologia", "categoria")


def line_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Generation and emission facts from one pass over the lines, clean or not."""
    def measure(dataset: str, indicator: str, unit: str, value):
        return F.struct(F.lit(dataset).alias("dataset"), F.lit(indicator).alias("indicador"),
                        value.alias("valor"), F.lit(unit).alias("unidad"))
    price = F.when(F.col("l_orderkey") % 13 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    both = F.array(measure("annual_generation_state", "generacion_electrica", "MWh", price),
                   measure("emission_annual", "emisiones_co2", "metric_tons_co2", F.col("l_quantity")))
    rows = lines(spark, folder).withColumns({
        "fuente_sitio": F.lit("lines"),
        "url_origen": F.lit("landed/lines"),
        "grupo": F.concat(F.lit("g"), (F.col("l_orderkey") % 2).cast("string")),
        "integrante": F.concat(F.lit("m"), (F.col("l_linenumber") % 3).cast("string")),
        "tema": F.when(F.col("l_linenumber") == 1, "  ").otherwise("energia"),
        "categoria_energia": F.when(F.col("l_orderkey") % 11 == 0, " \t").otherwise(F.col("categoria")),
        "item": F.concat(F.when(F.col("l_orderkey") % 7 == 0, " ").otherwise(""), item_label("region", "tecnologia")),
        "scraper_origen": F.lit("source_lines"),
    })
    return rows.select("*", F.inline(both)).select(*FACT_COLUMNS)


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "orders")).join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return _named_nations(rows, spark, folder, "c_nationkey").withColumns({
        "fuente_sitio": F.lit("orders"),
        "dataset": F.lit("projects"),
        "url_origen": F.lit("landed/orders"),
        "grupo": F.concat(F.lit("g"), (F.col("o_orderkey") % 2).cast("string")),
        "integrante": F.concat(F.lit("m"), (F.col("o_custkey") % 3).cast("string")),
        "tema": F.lit("energia"),
        "fecha_extraccion": F.col("o_orderdate").cast("string"),
        "periodo": F.year("o_orderdate"),
        "indicador": F.lit("potencia_neta"),
        "categoria_energia": classify("o_orderpriority"),
        "tecnologia": F.col("o_orderpriority"),
        "actor": F.col("c_name"),
        "item": F.col("o_orderkey").cast("string"),
        "valor": F.col("o_totalprice"),
        "unidad": F.lit("MW"),
        "scraper_origen": F.lit("source_orders"),
    }).select(*FACT_COLUMNS)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return line_facts(spark, folder).unionByName(order_facts(spark, folder))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_facts(facts(spark, folder))


def analysis(spark: SparkSession, folder: str) -> DataFrame:
    return analysis_facts(clean_facts(line_facts(spark, folder), PROFILE_COLUMNS))


def profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile_features(analysis(spark, folder))


def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile table written once, for what passes over it several times."""
    return materialize(profile(spark, folder), "profile")


_TECH_SQL = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TECHNOLOGY.items()) + " END"

LINES_SQL = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         CAST(l_shipdate AS VARCHAR) AS fecha_extraccion, CAST(year(l_shipdate) AS INTEGER) AS periodo,
         r_name AS pais, n_name AS region, s_name AS actor, {_TECH_SQL} AS tecnologia
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

CATEGORY_SQL = """CASE
  WHEN tecnologia = 'Pumped Storage' THEN 'Almacenamiento'
  WHEN tecnologia IN ('Solar Thermal and Photovoltaic', 'Wood and Wood Derived Fuels') THEN 'Renovable'
  WHEN tecnologia IN ('Natural Gas', 'Coal') THEN 'Fosil'
  WHEN tecnologia = 'Nuclear' THEN 'Nuclear' ELSE 'Otra' END"""

FACTS_SQL = f"""{LINES_SQL},
dirty AS (
  SELECT l.*, 'g' || (l_orderkey % 2) AS grupo, 'm' || (l_linenumber % 3) AS integrante,
         CASE WHEN l_linenumber = 1 THEN '  ' ELSE 'energia' END AS tema,
         CASE WHEN l_orderkey % 11 = 0 THEN ' ' || chr(9) ELSE {CATEGORY_SQL} END AS categoria_energia,
         CASE WHEN l_orderkey % 7 = 0 THEN ' ' ELSE '' END || l.region || ' - ' || tecnologia AS item,
         CASE WHEN l_orderkey % 13 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price
  FROM lines l),
facts AS (
  SELECT 'lines' AS fuente_sitio, dataset, 'landed/lines' AS url_origen, grupo, integrante, tema, fecha_extraccion,
         pais, region, periodo, indicador, categoria_energia, tecnologia, actor, item, valor, unidad,
         'source_lines' AS scraper_origen
  FROM (SELECT *, 'annual_generation_state' AS dataset, 'generacion_electrica' AS indicador, price AS valor,
               'MWh' AS unidad FROM dirty
        UNION ALL
        SELECT *, 'emission_annual', 'emisiones_co2', l_quantity, 'metric_tons_co2' FROM dirty) u
  UNION ALL
  SELECT 'orders', 'projects', 'landed/orders', 'g' || (o_orderkey % 2), 'm' || (o_custkey % 3), 'energia',
         CAST(o_orderdate AS VARCHAR), r_name, n_name, CAST(year(o_orderdate) AS INTEGER), 'potencia_neta', 'Otra',
         o_orderpriority, c_name, CAST(o_orderkey AS VARCHAR), o_totalprice, 'MW', 'source_orders'
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

_TEXT = ["fuente_sitio", "dataset", "url_origen", "grupo", "integrante", "tema", "fecha_extraccion", "pais", "region",
         "indicador", "categoria_energia", "tecnologia", "actor", "item", "unidad", "scraper_origen"]


def _strip_sql(c: str) -> str:
    return f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"


NORMAL_SQL = f"""{FACTS_SQL},
normal AS (SELECT {', '.join(f'{_strip_sql(c)} AS {c}' for c in _TEXT)}, periodo, valor FROM facts)"""


def _dedupe_sql(name: str, source: str, keys: list[str], where: str, columns: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT {', '.join(columns)}, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn
    FROM {source} WHERE {where}) t WHERE rn = 1)"""


_INTEGRATION = ["dataset", "item", "periodo", "indicador", "integrante", "valor"]
_ANALYSIS = ["dataset", "region", "periodo", "indicador", "tecnologia", "actor", "valor"]

CLEAN_SQL = f"""{NORMAL_SQL},
{_dedupe_sql('deduped', 'normal', _INTEGRATION, 'valor > 0 AND item IS NOT NULL', FACT_COLUMNS)},
clean AS (SELECT * REPLACE (coalesce(categoria_energia, 'Otra') AS categoria_energia) FROM deduped)"""

_COMPARED = ("dataset IN ('annual_generation_state', 'emission_annual') AND valor > 0 AND region IS NOT NULL "
             "AND categoria_energia IS NOT NULL")
ANALYSIS_SQL = f"""{NORMAL_SQL},
{_dedupe_sql('deduped', 'normal', _INTEGRATION, 'valor > 0 AND item IS NOT NULL', PROFILE_COLUMNS)},
clean AS (SELECT * REPLACE (coalesce(categoria_energia, 'Otra') AS categoria_energia) FROM deduped),
{_dedupe_sql('analysis', 'clean', _ANALYSIS, _COMPARED, PROFILE_COLUMNS)}"""

PROFILE_SQL = f"""{ANALYSIS_SQL},
aligned AS (
  SELECT periodo, region, categoria_energia,
         sum(CASE WHEN indicador = 'generacion_electrica' THEN valor ELSE 0.0 END) AS generacion_mwh,
         sum(CASE WHEN indicador = 'emisiones_co2' THEN valor ELSE 0.0 END) AS emisiones_co2_mt
  FROM analysis GROUP BY ALL),
derived AS (
  SELECT *, emisiones_co2_mt / generacion_mwh AS intensidad_co2,
         generacion_mwh / total_generacion_region AS participacion_generacion,
         ln(1 + generacion_mwh) AS log_generacion, ln(1 + emisiones_co2_mt) AS log_emisiones
  FROM (SELECT *, sum(generacion_mwh) OVER (PARTITION BY periodo, region) AS total_generacion_region
        FROM aligned WHERE generacion_mwh > 0 AND emisiones_co2_mt > 0) t),
profile AS (
  SELECT d.*, CASE WHEN sd > 0 THEN (intensidad_co2 - mean) / sd ELSE 0.0 END AS z_intensidad
  FROM derived d, (SELECT avg(intensidad_co2) AS mean, stddev_samp(intensidad_co2) AS sd FROM derived) s)"""
