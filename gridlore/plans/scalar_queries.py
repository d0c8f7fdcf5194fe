"""Scalar functions over text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlore.functions import automaton, numbers, text
from gridlore.operators.pages import title
from gridlore.plans.inputs import table
from gridlore.plans.registry import query


def _variant(n: int, *choices):
    """One of several spellings by row key."""
    which = (F.col("l_orderkey") + F.col("l_linenumber")) % n
    out = None
    for i, choice in enumerate(choices):
        out = F.when(which == i, choice) if out is None else out.when(which == i, choice)
    return out


NUMBER_TEXTS_SQL = """
texts AS (
  SELECT l_orderkey, l_linenumber,
    CASE (l_orderkey + l_linenumber) % 8
      WHEN 0 THEN plain WHEN 1 THEN replace(plain, '.', ',') WHEN 2 THEN '$ ' || plain
      WHEN 3 THEN grouped WHEN 4 THEN translate(grouped, ',.', '.,') WHEN 5 THEN '-'
      WHEN 6 THEN '' ELSE split_part(grouped, '.', 1) END AS texto
  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS plain,
               format('{:,.2f}', l_extendedprice) AS grouped FROM lineitem) t)"""


@query("parse_locale_number", f"""
WITH {NUMBER_TEXTS_SQL},
s AS (SELECT *, regexp_replace(texto, '[^0-9,.-]', '', 'g') AS s FROM texts)
SELECT l_orderkey, l_linenumber, texto, try_cast(CASE
  WHEN contains(s, ',') AND contains(s, '.') THEN
    CASE WHEN regexp_matches(s, ',[^.]*$') THEN replace(replace(s, '.', ''), ',', '.') ELSE replace(s, ',', '') END
  WHEN contains(s, ',') THEN
    CASE WHEN regexp_matches(s, ',.*,') OR regexp_matches(s, '^[0-9-]*[0-9][0-9-]*,.{{3}}$')
         THEN replace(s, ',', '') ELSE replace(s, ',', '.') END
  WHEN contains(s, '.') THEN
    CASE WHEN regexp_matches(s, '\\..*\\.') OR regexp_matches(s, '^[0-9-]*[0-9][0-9-]*\\..{{3}}$')
         THEN replace(s, '.', '') ELSE s END
  ELSE s END AS DOUBLE) AS valor FROM s""")
def parse_locale_number(spark, folder):
    plain = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    grouped = F.format_number("l_extendedprice", 2)
    texto = _variant(8, plain, F.regexp_replace(plain, r"\.", ","), F.concat(F.lit("$ "), plain), grouped,
                     F.translate(grouped, ",.", ".,"), F.lit("-"), F.lit(""), F.substring_index(grouped, ".", 1))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", texto.alias("texto"))
    return rows.withColumn("valor", numbers.parse_decimal_text("texto"))


@query("parse_year_int", """
SELECT l_orderkey, l_linenumber, texto,
       try_cast(trunc(CASE WHEN isnan(try_cast(texto AS DOUBLE)) THEN NULL ELSE try_cast(texto AS DOUBLE) END) AS INTEGER)
         AS periodo
FROM (SELECT l_orderkey, l_linenumber,
        CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN y WHEN 1 THEN y || '.0' WHEN 2 THEN y || '.9'
          WHEN 3 THEN ' ' || y || ' ' WHEN 4 THEN 'x' || y WHEN 5 THEN '-' || y || '.9' ELSE 'NaN' END AS texto
      FROM (SELECT *, CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem) t) u""")
def parse_year_int(spark, folder):
    y = F.year("l_shipdate").cast("string")
    texto = _variant(7, y, F.concat(y, F.lit(".0")), F.concat(y, F.lit(".9")), F.concat(F.lit(" "), y, F.lit(" ")),
                     F.concat(F.lit("x"), y), F.concat(F.lit("-"), y, F.lit(".9")), F.lit("NaN"))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", texto.alias("texto"))
    return rows.withColumn("periodo", numbers.parse_int("texto"))


@query("blank_to_null", r"""
SELECT c_custkey, nullif(regexp_replace(t, '^\s+|\s+$', '', 'g'), '') AS texto
FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN chr(9) || chr(10)
        WHEN 3 THEN ' ' || c_name || chr(9) ELSE c_name END AS t FROM customer) u""")
def blank_to_null(spark, folder):
    k = F.col("c_custkey") % 5
    t = (F.when(k == 0, "").when(k == 1, "  ").when(k == 2, "\t\n")
         .when(k == 3, F.concat(F.lit(" "), F.col("c_name"), F.lit("\t"))).otherwise(F.col("c_name")))
    return table(spark, folder, "customer").select("c_custkey", text.blank_to_null(t).alias("texto"))


@query("coerce_numeric", """
SELECT p_partkey, try_cast(CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN p_size || '.5d' WHEN 2 THEN p_size || '.5F'
  ELSE p_size || '.5' END AS DOUBLE) AS valor
FROM part""")
def coerce_numeric(spark, folder):
    number = F.concat(F.col("p_size").cast("string"), F.lit(".5"))
    raw = (F.when(F.col("p_size") % 5 == 0, F.col("p_name")).when(F.col("p_size") % 5 == 1, F.concat(number, F.lit("d")))
           .when(F.col("p_size") % 5 == 2, F.concat(number, F.lit("F"))).otherwise(number))
    return table(spark, folder, "part").select("p_partkey", numbers.to_double(raw).alias("valor"))


@query("default_category", """
SELECT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END, 'Otra') AS categoria,
       count(*) AS registros FROM orders GROUP BY 1""")
def default_category(spark, folder):
    raw = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return (table(spark, folder, "orders").groupBy(F.coalesce(raw, F.lit(text.DEFAULT_CATEGORY)).alias("categoria"))
            .agg(F.count("*").alias("registros")))


# fixed values: fuel names as sources spell them
FUELS = ["Pumped Storage", "Hydroelectric Conventional", "Other Gases", "Nuclear", "Eólico", "eolico", "BESS Hidro",
         "Wood and Wood Derived Fuels", "Petroleum", "Other", "Natural Gas"]


def _classified_sql(column: str) -> str:
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + f" THEN '{category}'"
        for category, words in text.CATEGORY_KEYWORDS)
    return f"CASE {branches} ELSE 'Otra' END"


@query("classify_keywords", f"""
SELECT p_partkey, texto, {_classified_sql('texto')} AS categoria
FROM (SELECT p_partkey, CASE p_partkey % {len(FUELS) + 1}
        {' '.join(f"WHEN {i} THEN '{fuel}'" for i, fuel in enumerate(FUELS))} END AS texto FROM part) t""")
def classify_keywords(spark, folder):
    which = F.col("p_partkey") % (len(FUELS) + 1)
    texto = F.when(which == 0, FUELS[0])
    for i, fuel in enumerate(FUELS[1:], 1):
        texto = texto.when(which == i, fuel)
    return (table(spark, folder, "part").select("p_partkey", texto.alias("texto"))
            .withColumn("categoria", text.classify("texto")))


@query("classify_documents", f"""
SELECT {_classified_sql('text')} AS categoria, count(*) AS documentos, CAST(sum(n_chars) AS BIGINT) AS caracteres
FROM documents GROUP BY 1""")
def classify_documents(spark, folder):
    return table(spark, folder, "documents").groupBy(text.classify("text").alias("categoria")).agg(
        F.count("*").alias("documentos"), F.sum("n_chars").alias("caracteres"))


@query("classify_by_table", """
WITH claves AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS palabra FROM benchmark),
hits AS (SELECT doc_id, arg_min(left(palabra, 1), -1000 * length(palabra) + ascii(left(palabra, 1))) AS categoria
         FROM documents JOIN claves ON contains(lower(text), palabra) GROUP BY doc_id)
SELECT d.doc_id, coalesce(h.categoria, 'Otra') AS categoria FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id""")
def classify_by_table(spark, folder):
    """Documents by the longest benchmark word they hold anywhere; every such word is a keyword, its first letter the category."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0)))
    words = table(spark, folder, "benchmark").select(word.alias("palabra")).distinct()
    rules = words.select((-F.char_length("palabra")).alias("orden"), F.left("palabra", F.lit(1)).alias("categoria"), "palabra")
    return automaton.classify_by_table(table(spark, folder, "documents"), "text", rules).select("doc_id", "categoria")


@query("snake_values", r"""
SELECT page_id, regexp_replace(regexp_replace(translate(lower(regexp_replace(titulo, '^\s+|\s+$', '', 'g')),
         ' ' || chr(10) || '-/áéíóúñ.,[]()', '____aeioun'), '_+', '_', 'g'), '^_|_$', '', 'g') AS nombre
FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS titulo FROM pages) t""")
def snake_values(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.snake(title()).alias("nombre"))


@query("year_from_date", """
SELECT o_orderkey, CAST(year(try_cast(CASE WHEN o_orderstatus = 'P' THEN 'pendiente'
  ELSE CAST(o_orderdate AS VARCHAR) END AS TIMESTAMP)) AS INTEGER) AS periodo FROM orders""")
def year_from_date(spark, folder):
    raw = F.when(F.col("o_orderstatus") == "P", "pendiente").otherwise(F.col("o_orderdate").cast("string"))
    return table(spark, folder, "orders").select("o_orderkey", text.year_of(raw).alias("periodo"))


@query("item_label", "SELECT p_brand || ' - ' || p_type AS item, count(*) AS registros FROM part GROUP BY 1")
def item_label(spark, folder):
    return (table(spark, folder, "part").groupBy(text.item_label("p_brand", "p_type").alias("item"))
            .agg(F.count("*").alias("registros")))


@query("brand_first_token", "SELECT p_partkey, split_part(p_name, ' ', 1) AS marca FROM part")
def brand_first_token(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.first_token("p_name").alias("marca"))


@query("currency_to_double", r"""
SELECT p_partkey, try_cast(regexp_replace(CASE p_partkey % 4 WHEN 0 THEN '£' || t WHEN 1 THEN 'Â£ ' || t
  WHEN 2 THEN 'gratis' ELSE format('{:,.2f}', p_retailprice) END, '[Â£,\s]', '', 'g') AS DOUBLE) AS valor
FROM (SELECT *, CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS VARCHAR) AS t FROM part) u""")
def currency_to_double(spark, folder):
    t, k = F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.col("p_partkey") % 4
    raw = (F.when(k == 0, F.concat(F.lit("£"), t)).when(k == 1, F.concat(F.lit("Â£ "), t))
           .when(k == 2, "gratis").otherwise(F.format_number("p_retailprice", 2)))
    return table(spark, folder, "part").select("p_partkey", numbers.currency_to_double(raw).alias("valor"))


@query("price_recombine", """
SELECT p_partkey, try_cast(translate(split_part(g, '.', 1), ',. ', '') || '.' ||
                           translate(split_part(g, '.', 2), ',. ', '') AS DOUBLE) AS valor
FROM (SELECT p_partkey, format('{:,.2f}', p_retailprice) AS g FROM part) t""")
def price_recombine(spark, folder):
    g = F.format_number("p_retailprice", 2)
    return table(spark, folder, "part").select("p_partkey", numbers.price_from_parts(
        F.concat(F.substring_index(g, ".", 1), F.lit(",")), F.substring_index(g, ".", -1)).alias("valor"))


@query("digits_only", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS valor FROM customer")
def digits_only(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", numbers.digits_only("c_name").alias("valor"))


@query("nan_to_null", """
SELECT l_returnflag, count(*) AS filas, count(CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END) AS validos
FROM lineitem GROUP BY 1""")
def nan_to_null(spark, folder):
    raw = F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount"))
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("filas"), F.count(numbers.nan_to_null(raw)).alias("validos"))


@query("record_key", """
SELECT c_custkey, sha256('m' || (c_custkey % 3) || '||projects||' || r_name || '||' || n_name || '||' ||
  '2001||potencia_neta||Otra||' || '||' || c_name || '||' ||
  CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END) AS registro_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def record_key(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    rows = (table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    named = rows.withColumns({
        "integrante": F.concat(F.lit("m"), (F.col("c_custkey") % 3).cast("string")), "dataset": F.lit("projects"),
        "pais": F.col("r_name"), "region": F.col("n_name"), "periodo": F.lit(2001),
        "indicador": F.lit("potencia_neta"), "categoria_energia": F.lit("Otra"), "actor": F.col("c_name"),
        "tecnologia": F.lit(None).cast("string"),
        "item": F.when(F.col("c_acctbal") > 0, F.col("c_custkey").cast("string"))})
    return named.select("c_custkey", text.record_key().alias("registro_id"))

