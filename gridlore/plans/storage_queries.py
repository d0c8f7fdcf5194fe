"""Sources and sinks: land tables in the shared folder, read them back; merges and the incremental job."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.functions.numbers import currency_to_double
from gridlore.functions.rows import one_row
from gridlore.functions.text import KEY_FIELDS
from gridlore.operators import batches, merge
from gridlore.operators.cleaning import INTEGRATION_KEY, clean_facts
from gridlore.operators.reshape import measures_to_rows
from gridlore.plans import inputs
from gridlore.plans.fact_queries import GENERATION_SQL, SOURCE_SQL, source_rows
from gridlore.plans.inputs import CLEAN_SQL, FACTS_SQL, NORMAL_SQL, table
from gridlore.plans.jobs import NEWEST, STORE_PARTITIONS, integrate, keyed
from gridlore.plans.registry import query
from gridlore.schema import FACT_COLUMNS
from gridlore.session import materialize, new_path
from gridlore.sources import dumps, files, sinks
from gridlore.sources.discovery import discover
from gridlore.sources.loaders import load_generation
from gridlore.sources.registry import SourceRegistry
from gridlore.streaming import changes, incremental

_LOADED = ["region", "periodo", "categoria_energia", "tecnologia", "actor", "item", "valor", "dataset", "indicador",
           "unidad", "integrante"]


def land_with_banner(df, banner: str, header: list[str], path: str) -> None:
    """CSV files whose header stands below a banner line, one file per part, as a workbook export gives them."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(c) for c in df.columns]
    body = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(parts)).alias("part"), F.lit(2).alias("rank"),
                     F.to_csv(F.struct(*columns)).alias("value"))
    top = df.sparkSession.range(parts).select(
        F.col("id").alias("part"),
        F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.lit(banner + "," * (len(header) - 1)).alias("value")),
                          F.struct(F.lit(1).alias("rank"), F.lit(",".join(header)).alias("value")))).alias("line")
    ).select("part", "line.*")
    lines = body.unionByName(top).repartition("part").sortWithinPartitions("part", "rank")
    lines.select("value", "part").write.partitionBy("part").text(path)


@query("src_banner_csv", f"WITH {SOURCE_SQL} {GENERATION_SQL}")
def src_banner_csv(spark, folder):
    rows = source_rows(spark, folder, "generation_megawatthours", "type_of_producer")
    path = new_path(spark, "banner-csv")
    header = ["Year", "State", "Type of Producer", "Energy Source", "Generation (Megawatthours)"]
    land_with_banner(rows, "Annual generation by state", header, path)
    schema = T.StructType([T.StructField(n, t) for n, t in zip(header, [
        T.IntegerType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType()])])
    landed = files.read_csv_with_banner(spark, path, schema)
    return load_generation(landed, {"integrante": "equipo"}, first_year=1997).select(*_LOADED)


_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@query("src_csv", "SELECT * FROM part")
def src_csv(spark, folder):
    path = new_path(spark, "csv")
    table(spark, folder, "part").write.option("header", True).csv(path)
    return files.read_csv(spark, path, T.StructType.fromDDL(_PART_SCHEMA))


@query("src_multipart_union", """
SELECT item, dataset, indicador, unidad, valor FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS item, 'p_clientes' AS dataset, 'potencia_neta' AS indicador, 'MW' AS unidad, c_acctbal AS valor FROM customer
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'bess', 'potencia_neta', 'MW', p_retailprice FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'bess', 'capacidad_almacenamiento', 'MWh', CAST(p_size AS DOUBLE) FROM part) t""")
def src_multipart_union(spark, folder):
    root = new_path(spark, "parts")
    parts = {
        "P. Clientes": (["Proyecto", "Potencia neta [MW]"],
                        table(spark, folder, "customer").select("c_custkey", "c_acctbal")),
        "BESS": (["Proyecto", "Potencia neta [MW]", "Capacidad de almacenamiento [MWh]"],
                 table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")),
        "Notas": (["Nota", "Texto"], table(spark, folder, "nation").select("n_nationkey", "n_name")),
    }
    for name, (header, df) in parts.items():
        land_with_banner(df, "Tabla", header, f"{root}/{name}")
    union = files.read_parts(spark, [f"{root}/{name}" for name in parts],
                             lambda path: parts[path.rsplit("/", 1)[-1]][0])
    long = measures_to_rows(union, {"potencia_neta_mw": ("potencia_neta", "MW"),
                                    "capacidad_de_almacenamiento_mwh": ("capacidad_almacenamiento", "MWh")},
                            ["proyecto", "dataset"])
    return long.withColumnRenamed("proyecto", "item")


# fixed value: keeps microseconds, which the writer's default drops
_MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_EVENTS = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double, props string"


@query("src_json_collection", """
SELECT event_type, count(*) AS registros, round(sum(value), 2) AS total, min(CAST(ts AS VARCHAR)) AS primero FROM events GROUP BY 1""")
def src_json_collection(spark, folder):
    path = new_path(spark, "collection")
    table(spark, folder, "events").write.options(**_MICROS).json(path)
    return files.read_collection(spark, T.StructType.fromDDL(_EVENTS), "json", path, **_MICROS).groupBy("event_type").agg(
        F.count("*").alias("registros"), F.round(F.sum("value"), 2).alias("total"),
        F.min(F.col("ts").cast("string")).alias("primero"))


@query("src_document_dump", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 24, '0') AS _id, o_orderkey, o_orderstatus, o_orderpriority AS prioridad, o_totalprice
FROM orders WHERE o_orderstatus = 'F'""")
def src_document_dump(spark, folder):
    """Orders as a document store's dump: wrapped numbers, object ids, a nested field; the status filter reaches the scan."""
    path = new_path(spark, "document-dump")
    orders = table(spark, folder, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 24, "0").alias("_id"), "o_orderkey", "o_orderstatus", "o_totalprice",
        F.struct(F.col("o_orderpriority").alias("prioridad"), F.array("o_orderkey").alias("claves")).alias("detalle"))
    dumps.write_dump(orders, path, object_ids=["_id"])
    schema = "_id string, o_orderkey long, o_orderstatus string, o_totalprice double, detalle struct<prioridad: string>"
    found = dumps.read_dump(spark, path, schema, only={"o_orderstatus": "F"})
    return found.select("_id", "o_orderkey", "o_orderstatus", "detalle.prioridad", "o_totalprice")


@query("src_fallback", "SELECT 'parquet' AS origen, c_custkey, c_name, c_acctbal FROM customer")
def src_fallback(spark, folder):
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double")
    empty = new_path(spark, "empty-collection")
    table(spark, folder, "customer").select(*schema.names).filter("false").write.json(empty)
    df, origin = files.read_first_available([
        ("absent", lambda: files.read_collection(spark, schema, "json", new_path(spark, "absent"))),
        ("empty", lambda: files.read_collection(spark, schema, "json", empty)),
        ("parquet", lambda: table(spark, folder, "customer").select(*schema.names)),
    ])
    return df.select(F.lit(origin).alias("origen"), "*")


@query("src_registry_union", f"""
WITH {FACTS_SQL} SELECT CASE dataset WHEN 'projects' THEN 'scraper_orders' ELSE 'scraper_lines' END AS scraper_origen,
       dataset, count(*) AS registros, round(sum(valor), 2) AS total FROM facts GROUP BY ALL""")
def src_registry_union(spark, folder):
    registry = SourceRegistry()
    registry.register("scraper_orders", inputs.order_facts)
    registry.register("scraper_lines", inputs.line_facts)
    return registry.load_all(spark, folder).groupBy("scraper_origen", "dataset").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))


@query("src_discovered_union", f"""
WITH {FACTS_SQL} SELECT CASE dataset WHEN 'projects' THEN 'scraper_orders' ELSE 'scraper_lines' END AS scraper_origen,
       dataset, count(*) AS registros, round(sum(valor), 2) AS total FROM facts GROUP BY ALL""")
def src_discovered_union(spark, folder):
    """The same rows from the source modules found in a package."""
    return discover("gridlore.plans.landed").load_all(spark, folder).groupBy("scraper_origen", "dataset").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))


@query("integration_job", f"""
WITH {NORMAL_SQL},
pairs AS (SELECT DISTINCT dataset, periodo FROM normal),
common AS (SELECT max(periodo) AS y FROM (SELECT periodo FROM pairs GROUP BY 1
           HAVING count(*) = (SELECT count(DISTINCT dataset) FROM pairs)) t),
kept AS (SELECT DISTINCT dataset, item, periodo, indicador, integrante, valor FROM normal, common
         WHERE periodo = y AND valor > 0 AND item IS NOT NULL)
SELECT integrante, dataset, count(*) AS registros, round(sum(valor), 2) AS total FROM kept GROUP BY ALL""")
def integration_job(spark, folder):
    """Sources, common period, cleaning, export and upsert in one run, reported by contributor and dataset."""
    registry = SourceRegistry()
    registry.register("scraper_orders", inputs.order_facts)
    registry.register("scraper_lines", inputs.line_facts)
    clean, _ = integrate(spark, registry, folder, new_path(spark, "job-store"), new_path(spark, "job-export"))
    return clean.groupBy("integrante", "dataset").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))


_EXPORTED = ["integrante", "dataset", "item", "periodo", "region", "categoria_energia", "valor"]


def _export_schema():
    return T.StructType([T.StructField(c, {"valor": T.DoubleType(), "periodo": T.IntegerType()}.get(c, T.StringType()))
                         for c in _EXPORTED])


def _export_rows(spark, folder):
    """Clean facts for export. Of repeats the least by all columns in their order stays, and that it is least up to the last exported
    column does not depend on those behind it: they are not read."""
    upto = FACT_COLUMNS.index("categoria_energia") + 1
    columns = [*FACT_COLUMNS[:upto], *[c for c in INTEGRATION_KEY if c not in FACT_COLUMNS[:upto]]]
    return clean_facts(inputs.facts(spark, folder), columns).select(*_EXPORTED)


@query("sink_csv_roundtrip", f"WITH {CLEAN_SQL} SELECT {', '.join(_EXPORTED)} FROM clean")
def sink_csv_roundtrip(spark, folder):
    path = new_path(spark, "export-csv")
    sinks.export_csv(_export_rows(spark, folder), path, compression="gzip")
    return files.read_csv(spark, path, _export_schema())


@query("sink_json_roundtrip", f"WITH {CLEAN_SQL} SELECT {', '.join(_EXPORTED)} FROM clean")
def sink_json_roundtrip(spark, folder):
    path = new_path(spark, "export-json")
    sinks.export_json(_export_rows(spark, folder), path, compression="gzip")
    return files.read_collection(spark, _export_schema(), "json", path)


@query("sink_parquet_roundtrip", f"""
WITH {CLEAN_SQL} SELECT dataset, periodo, count(*) AS registros, round(sum(valor), 2) AS total FROM clean GROUP BY ALL""")
def sink_parquet_roundtrip(spark, folder):
    path = new_path(spark, "facts")
    sinks.write_facts(inputs.clean(spark, folder), path)
    return spark.read.parquet(path).groupBy("dataset", "periodo").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))


# ---- merges: lines shipped before 2000 are stored, lines shipped from 1999 on arrive again, net of discount ----

_LINE_KEY = "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS registro_id"


def _stored(spark, folder):
    rows = table(spark, folder, "lineitem").filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    rows = rows.selectExpr(_LINE_KEY, "CAST(l_shipdate AS STRING) AS fecha", "l_extendedprice AS valor",
                           "l_returnflag AS nota", "l_quantity AS cantidad")
    return merge.latest_by(rows, ["registro_id"], ["fecha", "valor"])


def _arriving(spark, folder):
    rows = table(spark, folder, "lineitem").filter(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    rows = rows.selectExpr(_LINE_KEY, "CAST(l_shipdate AS STRING) AS fecha",
                           "round(l_extendedprice * (1 - l_discount), 4) AS valor", "nullif(l_returnflag, 'N') AS nota")
    return merge.latest_by(rows, ["registro_id"], ["fecha", "valor"])


_MERGE_SQL = """
stored AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY registro_id ORDER BY fecha DESC, valor DESC, nota DESC NULLS LAST, cantidad DESC) AS rn
    FROM (SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS registro_id,
                 CAST(l_shipdate AS VARCHAR) AS fecha, l_extendedprice AS valor, l_returnflag AS nota, l_quantity AS cantidad
          FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01') a) b WHERE rn = 1),
arriving AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY registro_id ORDER BY fecha DESC, valor DESC, nota DESC NULLS LAST) AS rn
    FROM (SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS registro_id,
                 CAST(l_shipdate AS VARCHAR) AS fecha, round(l_extendedprice * (1 - l_discount), 4) AS valor,
                 nullif(l_returnflag, 'N') AS nota
          FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01') a) b WHERE rn = 1)"""


@query("upsert_merge", f"""
WITH {_MERGE_SQL}
SELECT coalesce(a.registro_id, s.registro_id) AS registro_id,
       CASE WHEN a.registro_id IS NOT NULL THEN a.fecha ELSE s.fecha END AS fecha,
       CASE WHEN a.registro_id IS NOT NULL THEN a.valor ELSE s.valor END AS valor,
       CASE WHEN a.registro_id IS NOT NULL THEN a.nota ELSE s.nota END AS nota, s.cantidad
FROM stored s FULL JOIN arriving a ON s.registro_id = a.registro_id""")
def upsert_merge(spark, folder):
    return merge.upsert(_stored(spark, folder), _arriving(spark, folder), "registro_id").drop(merge.STATE)


_COUNTERS_SQL = """
SELECT count(*) FILTER (s.registro_id IS NULL) AS inserted,
       count(*) FILTER (s.registro_id IS NOT NULL AND (a.fecha IS DISTINCT FROM s.fecha OR a.valor IS DISTINCT FROM s.valor
                        OR a.nota IS DISTINCT FROM s.nota)) AS modified,
       count(*) FILTER (s.registro_id IS NOT NULL) AS matched
FROM arriving a LEFT JOIN stored s ON s.registro_id = a.registro_id"""


@query("upsert_counters", f"WITH {_MERGE_SQL} {_COUNTERS_SQL}")
def upsert_counters(spark, folder):
    return merge.upsert_counters(merge.upsert(_stored(spark, folder), _arriving(spark, folder), "registro_id"))


_KEY_SQL = "sha256(" + " || '||' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in KEY_FIELDS) + ")"


@query("upsert_table_reload", f"""
WITH {CLEAN_SQL},
keyed AS (SELECT *, {_KEY_SQL} AS registro_id FROM clean),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY registro_id
             ORDER BY fecha_extraccion DESC, valor DESC) AS rn FROM keyed) t WHERE rn = 1),
late AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY registro_id
             ORDER BY fecha_extraccion DESC, valor DESC) AS rn FROM keyed WHERE fecha_extraccion >= '2000-01-01') t WHERE rn = 1)
SELECT l.dataset, l.periodo, count(*) AS registros, round(sum(l.valor), 2) AS total,
       (SELECT count(*) FROM late) AS matched, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS modified
FROM latest l GROUP BY ALL""")
def upsert_table_reload(spark, folder):
    """Loads all facts into a stored table, then loads those extracted since 2000 again: nothing changes."""
    clean = materialize(inputs.clean(spark, folder), "reload-facts")
    path = new_path(spark, "keyed-table")
    merge.upsert_table(path, keyed(clean), "registro_id", STORE_PARTITIONS, NEWEST)
    again = keyed(clean.filter(F.col("fecha_extraccion") >= "2000-01-01"))
    counters = merge.upsert_table(path, again, "registro_id", STORE_PARTITIONS, NEWEST)
    report = spark.read.parquet(path).groupBy("dataset", "periodo").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))
    counts = one_row(counters)
    return report.withColumns({c: counts[c] for c in counters.columns})


def _replacement(spark, folder):
    stored = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("grupo"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("categoria"),
        F.col("o_totalprice").alias("valor"))
    fresh = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.lit("F").alias("grupo"), F.lit("1-URGENT").alias("categoria"),
        F.col("c_acctbal").alias("valor"))
    return stored, fresh, (F.col("grupo") == "F") & (F.col("categoria") == "1-URGENT")


@query("replace_where", """
SELECT o_orderkey, o_orderstatus AS grupo, nullif(o_orderpriority, '5-LOW') AS categoria, o_totalprice AS valor FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
UNION ALL SELECT c_custkey, 'F', '1-URGENT', c_acctbal FROM customer""")
def replace_where(spark, folder):
    return merge.replace_where(*_replacement(spark, folder))


@query("replace_keys", """
SELECT o_orderkey, o_orderstatus AS grupo, nullif(o_orderpriority, '5-LOW') AS categoria, o_totalprice AS valor FROM orders
WHERE o_orderstatus <> 'F' UNION ALL SELECT c_custkey, 'F', '1-URGENT', c_acctbal FROM customer""")
def replace_keys(spark, folder):
    stored, fresh, _ = _replacement(spark, folder)
    return merge.replace_keys(stored, fresh, ["grupo"]).select("o_orderkey", "grupo", "categoria", "valor")


@query("replace_counters", """
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS deleted,
       (SELECT count(*) FROM customer) AS inserted""")
def replace_counters(spark, folder):
    return merge.replace_counters(*_replacement(spark, folder))


@query("replace_table_reload", """
SELECT o_orderstatus AS grupo, count(*) AS registros, round(sum(o_totalprice), 2) AS total, 0 AS nuevos, 0 AS borrados,
  count(*) AS notas FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1
UNION ALL SELECT 'F', count(*), round(sum(c_acctbal), 2), count(*), count(*), 0 FROM customer""")
def replace_table_reload(spark, folder):
    """A stored table whose one group is replaced twice; the second run deletes what the first inserted. Only the table has notes."""
    stored = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("grupo"), F.col("o_totalprice").alias("valor"),
                                                   F.lit("nota").alias("nota"))
    fresh = table(spark, folder, "customer").select(F.lit("F").alias("grupo"), F.col("c_acctbal").alias("valor"))
    path = new_path(spark, "replaced")
    merge.replace_table(path, stored, ["grupo"], ["grupo"])
    merge.replace_table(path, fresh, ["grupo"], ["grupo"])
    tallies = merge.replace_table(path, fresh, ["grupo"], ["grupo"])
    is_new = F.col("grupo") == "F"
    after = spark.read.schema("valor double, nota string, grupo string").parquet(path)
    return after.groupBy("grupo").agg(F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"), F.count("nota").alias("notas")).select(
        "grupo", "registros", "total", F.when(is_new, tallies.select("inserted").scalar()).otherwise(F.lit(0).cast("long")).alias("nuevos"),
        F.when(is_new, tallies.select("deleted").scalar()).otherwise(F.lit(0).cast("long")).alias("borrados"), "notas")


@query("append_quarantine", """
SELECT CASE WHEN p_type = 'PROMO' THEN 'cuarentena' ELSE 'cargado' END AS destino, count(*) AS registros,
       round(sum(CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END), 2) AS total,
       (SELECT count(*) FROM part WHERE p_type <> 'PROMO') AS exitosos,
       (SELECT count(*) FROM part WHERE p_type = 'PROMO') AS fallidos
FROM part GROUP BY 1""")
def append_quarantine(spark, folder):
    raw = F.when(F.col("p_type") == "PROMO", "consultar").otherwise(
        F.concat(F.lit("£"), F.format_number("p_retailprice", 2)))
    rows = table(spark, folder, "part").select("p_partkey", raw.alias("valor"))
    good, bad = new_path(spark, "loaded"), new_path(spark, "quarantine")
    tallies = merge.append_with_quarantine(rows, "valor", currency_to_double("valor"), good, bad)
    loaded = spark.read.parquet(good).select(F.lit("cargado").alias("destino"), "valor")
    held = spark.read.parquet(bad).select(F.lit("cuarentena").alias("destino"), F.lit(None).cast("double").alias("valor"))
    report = loaded.unionByName(held).groupBy("destino").agg(
        F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))
    counts = one_row(tallies)
    return report.withColumns({c: counts[c] for c in tallies.columns})


@query("append_batch_twice", """
SELECT lote, CASE WHEN p_type = 'PROMO' THEN 'cuarentena' ELSE 'cargado' END AS estado, count(*) AS registros,
       round(sum(CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END), 2) AS total,
       (SELECT count(*) FROM part WHERE p_type <> 'PROMO') AS exitosos, (SELECT count(*) FROM part WHERE p_type = 'PROMO') AS fallidos
FROM part, (VALUES ('dia-1'), ('dia-2')) b(lote) GROUP BY ALL""")
def append_batch_twice(spark, folder):
    """Two batches of prices, the first one run twice: every batch stands there once. Tallies come from the writes."""
    raw = F.when(F.col("p_type") == "PROMO", "consultar").otherwise(F.concat(F.lit("£"), F.format_number("p_retailprice", 2)))
    rows = table(spark, folder, "part").select("p_partkey", raw.alias("valor"))
    path = new_path(spark, "batches")
    for batch in ("dia-1", "dia-2", "dia-1"):
        counts = batches.append_batch(rows, "valor", currency_to_double("valor"), path, batch)
    report = spark.read.parquet(path).groupBy("lote", "estado").agg(F.count("*").alias("registros"), F.round(F.sum("valor"), 2).alias("total"))
    return report.withColumns({name: F.lit(n).cast("long") for name, n in counts.items()})


@query("checks_observed", f"""
WITH {FACTS_SQL} SELECT count(*) AS registros, count(*) FILTER (valor <= 0) AS no_positivos, count(*) FILTER (trim(tema) = '') AS sin_tema,
       count(DISTINCT dataset) AS datasets, min(periodo) AS primero, max(periodo) AS ultimo FROM facts""")
def checks_observed(spark, folder):
    """Checks of the facts tallied by the job that writes them, next to what a count of the stored table gives."""
    path = new_path(spark, "checked-facts")
    seen = batches.observed_write(
        inputs.facts(spark, folder), lambda df: df.write.parquet(path), registros=F.count("*"), no_positivos=F.count_if(F.col("valor") <= 0),
        sin_tema=F.count_if(F.trim("tema") == ""), primero=F.min("periodo"), ultimo=F.max("periodo"))
    stored = spark.read.parquet(path).agg(F.count_distinct("dataset").alias("datasets"))
    return stored.select(
        *[F.lit(seen[c]).cast("long").alias(c) for c in ("registros", "no_positivos", "sin_tema")], "datasets",
        *[F.lit(seen[c]).cast("int").alias(c) for c in ("primero", "ultimo")])


@query("stream_upsert_events", """
WITH sent AS (
  SELECT event_id, ts, value FROM events
  UNION ALL SELECT event_id, ts + INTERVAL 1 DAY, value * 2 FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_id, ts - INTERVAL 1 DAY, -value FROM events WHERE event_type = 'click')
SELECT event_id, CAST(ts AS VARCHAR) AS ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM sent) t WHERE rn = 1""")
def stream_upsert_events(spark, folder):
    """Events arrive with late copies of clicks; in a second run errors arrive again, a day newer with a new value."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    kind = table(spark, folder, "events")
    newer = kind.filter("event_type = 'error'").selectExpr("event_id", "ts + INTERVAL 1 DAY AS ts", "value * 2 AS value")
    older = kind.filter("event_type = 'click'").selectExpr("event_id", "ts - INTERVAL 1 DAY AS ts", "-value AS value")
    landing, stored, state = (new_path(spark, name) for name in ("landing", "stream-table", "stream-state"))
    for arrival in ([events, older], [newer]):
        for part in arrival:
            part.write.mode("append").parquet(landing)
        stream = incremental.read_files(spark, landing, events.schema)
        incremental.run_upsert(stream, stored, ["event_id"], ["ts"], state)
    now = incremental.current_rows(spark, stored, events.schema, ["event_id"], ["ts"])
    return now.select("event_id", F.col("ts").cast("string").alias("ts"), "value")


@query("stream_change_feed", """
WITH sent AS (
  SELECT 1 AS entrega, event_id, event_type, ts, value FROM events
  UNION ALL SELECT 1, event_id, event_type, ts - INTERVAL 1 DAY, -value FROM events WHERE event_type = 'click'
  UNION ALL SELECT 2, event_id, event_type, ts + INTERVAL 1 DAY, value + 1 FROM events WHERE event_type = 'error'
  UNION ALL SELECT 2, event_id, event_type, ts + INTERVAL 1 DAY, value FROM events WHERE event_type = 'signup'
  UNION ALL SELECT 2, event_id, event_type, ts, value FROM events),
per_run AS (
  SELECT *, row_number() OVER (PARTITION BY event_id, entrega ORDER BY ts DESC) AS rn FROM sent),
seen AS (
  SELECT *, lag(ts) OVER w AS ts_antes, lag(value) OVER w AS value_antes, lag(entrega) OVER w AS antes
  FROM per_run WHERE rn = 1 WINDOW w AS (PARTITION BY event_id ORDER BY entrega))
SELECT event_id, event_type, CAST(ts AS VARCHAR) AS ts, value, CASE WHEN antes IS NULL THEN 'alta' ELSE 'cambio' END AS tipo,
  CAST(entrega AS BIGINT) AS version
FROM seen WHERE antes IS NULL OR (ts > ts_antes AND value <> value_antes)""")
def stream_change_feed(spark, folder):
    """Changed keys of two runs: the second brings errors a day newer with other values, signups only newer, and all events again."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")

    def moved(kind: str, days: str, value: str):
        return events.filter(F.col("event_type") == kind).selectExpr(
            "event_id", "event_type", f"ts {days} AS ts", f"{value} AS value")

    landing, feed, state = (new_path(spark, name) for name in ("landing", "change-feed", "feed-state"))
    for arrival in ([events, moved("click", "- INTERVAL 1 DAY", "-value")],
                    [moved("error", "+ INTERVAL 1 DAY", "value + 1"), moved("signup", "+ INTERVAL 1 DAY", "value"), events]):
        for part in arrival:
            part.write.mode("append").parquet(landing)
        stream = incremental.read_files(spark, landing, events.schema)
        changes.run_changes(changes.change_feed(stream, ["event_id"], ["ts"]), feed, state)
    return spark.read.parquet(feed).select("event_id", "event_type", F.col("ts").cast("string").alias("ts"), "value",
                                           F.col(changes.KIND).alias("tipo"), F.col(changes.VERSION).alias("version"))
