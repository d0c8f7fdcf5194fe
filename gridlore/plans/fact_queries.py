"""The fact table: projection, loading, cleaning, periods, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlore.operators import cleaning, periods, profiles
from gridlore.operators.reshape import measures_to_rows
from gridlore.plans import inputs
from gridlore.plans.inputs import ANALYSIS_SQL, CATEGORY_SQL, CLEAN_SQL, FACTS_SQL, LINES_SQL, NORMAL_SQL, PROFILE_SQL, table
from gridlore.plans.registry import query
from gridlore.schema import FACT_COLUMNS, project
from gridlore.sources.loaders import load_emissions, load_generation, load_projects

_ALL = ", ".join(FACT_COLUMNS)


_PROJECTED = {"dataset": "'customers'", "region": "CAST(c_nationkey AS VARCHAR)", "actor": "c_name",
              "item": "CAST(c_custkey AS VARCHAR)", "valor": "c_acctbal", "periodo": "CAST(NULL AS INTEGER)"}


@query("canonical_projection", "SELECT " + ", ".join(
    f"{_PROJECTED.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in FACT_COLUMNS) + " FROM customer")
def canonical_projection(spark, folder):
    return project(table(spark, folder, "customer").select(
        F.lit("customers").alias("dataset"), F.col("c_nationkey").alias("region"), F.col("c_name").alias("actor"),
        F.col("c_custkey").alias("item"), F.col("c_acctbal").alias("valor")))


@query("clean_records", f"WITH {CLEAN_SQL} SELECT {_ALL} FROM clean")
def clean_records(spark, folder):
    return inputs.clean(spark, folder)


@query("eda_clean", f"WITH {ANALYSIS_SQL} SELECT * FROM analysis")
def eda_clean(spark, folder):
    return inputs.analysis(spark, folder)


_LOADED = ["region", "periodo", "categoria_energia", "tecnologia", "actor", "item", "valor", "dataset", "indicador", "unidad",
           "integrante"]

SOURCE_SQL = f"""{LINES_SQL},
source AS (
  SELECT periodo, CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE region END AS region, actor,
         CASE l_linenumber WHEN 7 THEN 'Total' WHEN 6 THEN 'All Sources' ELSE tecnologia END AS tecnologia,
         CASE WHEN l_orderkey % 13 = 0 THEN 0.0 WHEN l_orderkey % 17 = 0 THEN -1.0 ELSE l_extendedprice END AS price
  FROM lines)"""


def source_rows(spark, folder, value: str, producer: str):
    """Lines under the headers of a state table, with subtotals, unnamed regions and values below one."""
    price = (F.when(F.col("l_orderkey") % 13 == 0, 0.0).when(F.col("l_orderkey") % 17 == 0, -1.0)
             .otherwise(F.col("l_extendedprice")))
    return inputs.lines(spark, folder).select(
        F.col("periodo").alias("year"),
        F.when(F.col("l_orderkey") % 19 != 0, F.col("region")).alias("state"),
        F.col("actor").alias(producer),
        F.when(F.col("l_linenumber") == 7, "Total").when(F.col("l_linenumber") == 6, "All Sources")
        .otherwise(F.col("tecnologia")).alias("energy_source"),
        price.alias(value))


def loaded_sql(dataset: str, indicator: str, unit: str, condition: str) -> str:
    return f"""SELECT region, periodo, {CATEGORY_SQL} AS categoria_energia, tecnologia, actor,
  region || ' - ' || tecnologia AS item, price AS valor, '{dataset}' AS dataset, '{indicator}' AS indicador,
  '{unit}' AS unidad, 'equipo' AS integrante FROM source
WHERE periodo >= 1997 AND region IS NOT NULL AND tecnologia NOT IN ('Total', 'All Sources') AND {condition}"""


GENERATION_SQL = loaded_sql("annual_generation_state", "generacion_electrica", "MWh", "price > 0")
EMISSIONS_SQL = loaded_sql("emission_annual", "emisiones_co2", "metric_tons_co2", "price >= 0")


@query("load_generation_like", f"WITH {SOURCE_SQL} {GENERATION_SQL}")
def load_generation_like(spark, folder):
    rows = source_rows(spark, folder, "generation_megawatthours", "type_of_producer")
    return load_generation(rows, {"integrante": "equipo"}, first_year=1997).select(*_LOADED)


@query("load_emissions_like", f"WITH {SOURCE_SQL} {EMISSIONS_SQL}")
def load_emissions_like(spark, folder):
    rows = source_rows(spark, folder, "co2_metric_tons", "producer_type")
    return load_emissions(rows, {"integrante": "equipo"}, first_year=1997).select(*_LOADED)


@query("load_projects_like", """
WITH sheet AS (
  SELECT o_orderstatus AS region, CAST(year(o_orderdate) AS INTEGER) AS periodo, CAST(o_custkey AS VARCHAR) AS actor,
         CASE o_orderkey % 3 WHEN 0 THEN 'Renovable' WHEN 1 THEN 'Almacenamiento' ELSE 'Otra' END AS categoria_energia,
         CASE o_orderkey % 3 WHEN 0 THEN 'Solar Fotovoltaico' WHEN 1 THEN 'BESS' ELSE 'Otro' END AS tecnologia,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS item,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS power,
         CAST(CASE WHEN o_orderkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS DOUBLE) AS storage FROM orders),
measured AS (
  SELECT *, power AS valor, 'potencia_neta' AS indicador, 'MW' AS unidad FROM sheet
  UNION ALL SELECT *, storage, 'capacidad_almacenamiento', 'MWh' FROM sheet)
SELECT region, periodo, categoria_energia, tecnologia, actor, item, valor, 'proyectos' AS dataset, indicador, unidad,
       'equipo' AS integrante FROM measured WHERE valor > 0 AND item IS NOT NULL""")
def load_projects_like(spark, folder):
    key = F.col("o_orderkey")
    sheet = table(spark, folder, "orders").select(
        F.lit("proyectos").alias("dataset"), F.col("o_orderstatus").alias("ubicacion"),
        F.col("o_orderdate").cast("string").alias("fecha_estimada_de_interconexion"),
        F.when(key % 3 == 0, "Solar Fotovoltaico").when(key % 3 == 1, "BESS").otherwise("Otro").alias("tipo_de_tecnologia"),
        F.col("o_custkey").cast("string").alias("propietario"), F.when(key % 11 != 0, key.cast("string")).alias("proyecto"),
        F.when(key % 5 != 0, F.col("o_totalprice")).alias("potencia_neta_mw"),
        F.when(key % 7 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("capacidad_de_almacenamiento_mwh"))
    return load_projects(sheet, {"integrante": "equipo"}).select(*_LOADED)


@query("unpivot_measures", """
SELECT p_partkey, 'potencia_neta' AS indicador, 'MW' AS unidad, CAST(p_size AS DOUBLE) AS valor FROM part
UNION ALL SELECT p_partkey, 'capacidad_almacenamiento', 'MWh', p_retailprice FROM part WHERE p_type <> 'SMALL'""")
def unpivot_measures(spark, folder):
    rows = table(spark, folder, "part").withColumn(
        "p_retailprice", F.when(F.col("p_type") != "SMALL", F.col("p_retailprice")))
    return measures_to_rows(rows, {"p_size": ("potencia_neta", "MW"), "p_retailprice": ("capacidad_almacenamiento", "MWh"),
                                   "p_absent": ("ausente", "MW")}, ["p_partkey"])


@query("dedupe_integration", f"""
WITH {NORMAL_SQL} SELECT DISTINCT dataset, item, periodo, indicador, integrante, valor FROM normal""")
def dedupe_integration(spark, folder):
    facts = cleaning.normalize(inputs.facts(spark, folder), cleaning.INTEGRATION_KEY)
    return cleaning.distinct_by(facts, cleaning.INTEGRATION_KEY)


@query("dedupe_eda", f"""
WITH {FACTS_SQL}
SELECT dataset, region, periodo, indicador, tecnologia, actor, valor, min(integrante) AS integrante
FROM facts GROUP BY ALL""")
def dedupe_eda(spark, folder):
    facts = inputs.facts(spark, folder).select(*cleaning.ANALYSIS_KEY, "integrante")
    return cleaning.distinct_by(facts, cleaning.ANALYSIS_KEY)


@query("dropna_features", """
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0""")
def dropna_features(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in ("l_discount", "l_tax")])
    return rows.na.drop(subset=["l_discount", "l_tax"])


@query("filter_threshold", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 40000 AND l_returnflag = 'R'""")
def filter_threshold(spark, folder):
    return (table(spark, folder, "lineitem").filter((F.col("l_extendedprice") > 40000) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_extendedprice"))


@query("dq_checks", f"""
WITH {FACTS_SQL} SELECT count(*) >= 100 AS enough_rows, true AS enough_columns, min(periodo) = max(periodo) AS one_year,
       count(*) > 0 AS not_empty FROM facts""")
def dq_checks(spark, folder):
    return cleaning.quality_checks(inputs.facts(spark, folder))


@query("exclude_subtotals", f"""
WITH {SOURCE_SQL} SELECT tecnologia, count(*) AS registros FROM source
WHERE tecnologia NOT IN ('Total', 'All Sources') AND (region IS NULL OR region <> 'NATION_0') GROUP BY 1""")
def exclude_subtotals(spark, folder):
    rows = source_rows(spark, folder, "valor", "actor").withColumnsRenamed({"energy_source": "tecnologia", "state": "region"})
    kept = cleaning.exclude_members(rows, {"tecnologia": cleaning.SUBTOTALS, "region": ["NATION_0"]})
    return kept.groupBy("tecnologia").agg(F.count("*").alias("registros"))


def _with_events(spark, folder):
    """Facts and the yearly event counts, which share no period with them."""
    events = table(spark, folder, "events").select(F.lit("events").alias("dataset"), F.year("ts").alias("periodo"))
    return inputs.facts(spark, folder).select("dataset", "periodo").unionByName(events)


_PAIRS_SQL = f"""{FACTS_SQL},
pairs AS (SELECT DISTINCT dataset, periodo FROM facts)"""


@query("years_by_dataset", f"""
WITH {_PAIRS_SQL} SELECT dataset, string_agg(CAST(periodo AS VARCHAR), ',' ORDER BY periodo) AS periodos
FROM pairs GROUP BY 1""")
def years_by_dataset(spark, folder):
    years = periods.years_by_dataset(inputs.facts(spark, folder))
    return years.select("dataset", F.array_join("periodos", ",").alias("periodos"))


@query("common_year", f"""
WITH {_PAIRS_SQL} SELECT max(periodo) AS periodo
FROM (SELECT periodo FROM pairs GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT dataset) FROM pairs)) t""")
def common_year(spark, folder):
    return periods.common_year(inputs.facts(spark, folder))


@query("common_year_missing", f"""
WITH {FACTS_SQL},
pairs AS (SELECT DISTINCT dataset, periodo FROM facts UNION SELECT 'events', CAST(year(ts) AS INTEGER) FROM events)
SELECT dataset FROM pairs GROUP BY 1 HAVING NOT bool_or(periodo = 2001)""")
def common_year_missing(spark, folder):
    return periods.missing_datasets(_with_events(spark, folder), 2001)


@query("filter_common_year", f"""
WITH {_PAIRS_SQL},
common AS (SELECT max(periodo) AS y FROM (SELECT periodo FROM pairs GROUP BY 1
           HAVING count(*) = (SELECT count(DISTINCT dataset) FROM pairs)) t)
SELECT dataset, periodo, item, integrante, valor FROM facts WHERE periodo = (SELECT y FROM common)""")
def filter_common_year(spark, folder):
    facts = inputs.facts(spark, folder).select("dataset", "periodo", "item", "integrante", "valor")
    return periods.keep_common_year(facts)


_MEASURES = ["generacion_mwh", "emisiones_co2_mt"]
_ALIGNED_SELECT = """SELECT periodo, region, categoria_energia, round(generacion_mwh, 2) AS generacion_mwh,
  round(emisiones_co2_mt, 2) AS emisiones_co2_mt"""


def _rounded(df, digits, columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("profile_align", f"WITH {PROFILE_SQL} {_ALIGNED_SELECT} FROM profile")
def profile_align(spark, folder):
    return _rounded(profiles.aligned_measures(inputs.analysis(spark, folder)), 2, _MEASURES)


@query("profile_align_join", f"""
WITH {ANALYSIS_SQL},
g AS (SELECT periodo, region, categoria_energia, sum(valor) AS generacion_mwh FROM analysis
      WHERE indicador = 'generacion_electrica' GROUP BY ALL),
e AS (SELECT periodo, region, categoria_energia, sum(valor) AS emisiones_co2_mt FROM analysis
      WHERE indicador = 'emisiones_co2' GROUP BY ALL)
{_ALIGNED_SELECT} FROM g JOIN e USING (periodo, region, categoria_energia)""")
def profile_align_join(spark, folder):
    return _rounded(profiles.aligned_measures_by_join(inputs.analysis(spark, folder)), 2, _MEASURES)


@query("profile_features", f"""
WITH {PROFILE_SQL}
SELECT periodo, region, categoria_energia, round(generacion_mwh, 2) AS generacion_mwh,
  round(emisiones_co2_mt, 2) AS emisiones_co2_mt, round(total_generacion_region, 2) AS total_generacion_region,
  round(intensidad_co2, 9) AS intensidad_co2, round(participacion_generacion, 9) AS participacion_generacion,
  round(log_generacion, 9) AS log_generacion, round(log_emisiones, 9) AS log_emisiones,
  round(z_intensidad, 6) AS z_intensidad FROM profile""")
def profile_features(spark, folder):
    df = inputs.profile(spark, folder)
    df = _rounded(df, 2, [*_MEASURES, "total_generacion_region"])
    df = _rounded(df, 9, ["intensidad_co2", "participacion_generacion", "log_generacion", "log_emisiones"])
    return _rounded(df, 6, ["z_intensidad"])


@query("category_rule", f"""
WITH {LINES_SQL} SELECT tecnologia, {CATEGORY_SQL} AS categoria, count(*) AS registros FROM lines GROUP BY ALL""")
def category_rule(spark, folder):
    return inputs.lines(spark, folder).groupBy("tecnologia", "categoria").agg(
        F.count("*").alias("registros"))
