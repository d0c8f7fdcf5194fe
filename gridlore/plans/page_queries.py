"""Extraction over landed pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlore.operators import pages
from gridlore.operators.chains import page_chains as follow
from gridlore.plans.inputs import table
from gridlore.plans.registry import query

# a navigation entry is the card of these pages: the block, then fields inside it
CARD = r"<li>(<a\s.*?</a>)</li>"
FIELDS = {"enlace": r'href="([^"]*)"', "texto": r">([^<]*)</a>"}

_CARDS_SQL = r"""
blocks AS (SELECT page_id, url, regexp_extract_all(html, '<li>(<a\s.*?</a>)</li>', 1) AS b FROM pages),
cards AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS posicion, regexp_extract(card, 'href="([^"]*)"', 1) AS enlace,
         regexp_replace(regexp_extract(card, '>([^<]*)</a>', 1), '^\s+|\s+$', '', 'g') AS texto
  FROM (SELECT page_id, unnest(b) AS card, generate_subscripts(b, 1) AS i FROM blocks) t)"""


def _cards(spark, folder, first=None):
    return pages.cards(table(spark, folder, "pages"), CARD, FIELDS, ["page_id"], first)


@query("page_title", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS titulo FROM pages")
def page_title(spark, folder):
    return table(spark, folder, "pages").select("page_id", pages.title().alias("titulo"))


@query("page_element_texts", r"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS posicion, regexp_replace(t, '^\s+|\s+$', '', 'g') AS texto
FROM (SELECT page_id, unnest(x) AS t, generate_subscripts(x, 1) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<p(?:\s[^>]*)?>([^<]*)</p>', 1) AS x FROM pages) u) v""")
def page_element_texts(spark, folder):
    return pages.element_texts(table(spark, folder, "pages"), "p", ["page_id"])


@query("page_cards", f"""
WITH {_CARDS_SQL} SELECT *, 'equipo' AS grupo, '2024-01-31 08:00:00' AS fecha_captura FROM cards""")
def page_cards(spark, folder):
    return pages.stamp(_cards(spark, folder), "equipo", "2024-01-31 08:00:00")


@query("page_cards_prefer", f"""
WITH {_CARDS_SQL} SELECT page_id, posicion, coalesce(nullif(substr(enlace, 2), ''), nullif(texto, '')) AS item FROM cards""")
def page_cards_prefer(spark, folder):
    return _cards(spark, folder).select(
        "page_id", "posicion", pages.prefer(F.substring("enlace", 2, 2**31 - 1), F.col("texto")).alias("item"))


@query("page_cards_topn", f"WITH {_CARDS_SQL} SELECT * FROM cards WHERE posicion < 3")
def page_cards_topn(spark, folder):
    return _cards(spark, folder, 3)


# a card is rejected here when its link names no word character
_REJECT_FIELDS = {"enlace": r'href="(/\w+)"', "texto": r">([^<]*)</a>"}


@query("page_cards_rejects", r"""
WITH blocks AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(<a\s.*?</a>)</li>', 1)) AS card FROM pages)
SELECT CASE WHEN regexp_extract(card, 'href="(/\w+)"', 1) <> '' AND trim(regexp_extract(card, '>([^<]*)</a>', 1)) <> ''
            THEN 'valida' ELSE 'rechazada' END AS estado, count(*) AS tarjetas FROM blocks GROUP BY 1""")
def page_cards_rejects(spark, folder):
    found = pages.cards(table(spark, folder, "pages"), CARD, _REJECT_FIELDS, ["page_id"])
    good, bad = pages.split_rejects(found, list(_REJECT_FIELDS))
    both = good.withColumn("estado", F.lit("valida")).unionByName(bad.withColumn("estado", F.lit("rechazada")))
    return both.groupBy("estado").agg(F.count("*").alias("tarjetas"))


@query("page_links_resolved", r"""
SELECT page_id, CAST(i - 1 AS INTEGER) AS posicion, href,
       CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
            ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS destino
FROM (SELECT page_id, url, unnest(x) AS href, generate_subscripts(x, 1) AS i
      FROM (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1) AS x FROM pages) u) v""")
def page_links_resolved(spark, folder):
    return pages.page_links(table(spark, folder, "pages"), ["page_id"])


# these pages name no following page: the last entry of the navigation stands for it
_NEXT = r'<li><a href="([^"]*)">[^<]*</a></li></ul>'


@query("page_next_link", r"""
SELECT page_id, CASE
  WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
  ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS siguiente
FROM (SELECT page_id, url, regexp_extract(html, '<li><a href="([^"]*)">[^<]*</a></li></ul>', 1) AS href FROM pages
      WHERE regexp_matches(html, '<li><a href="([^"]*)">[^<]*</a></li></ul>')) t""")
def page_next_link(spark, folder):
    return pages.next_links(table(spark, folder, "pages"), _NEXT, ["page_id"])


_CHAIN_SQL = """
landed AS (SELECT l.pagina, l.siguiente, CASE WHEN l.siguiente IS NULL THEN 'fin' WHEN n.pagina IS NULL THEN 'ausente' ELSE 'sigue' END AS estado
           FROM links l LEFT JOIN (SELECT pagina FROM links) n ON l.siguiente = n.pagina),
reach(inicio, pagina) AS (SELECT pagina, siguiente FROM landed WHERE estado = 'sigue'
                          UNION SELECT r.inicio, l.siguiente FROM reach r JOIN landed l ON r.pagina = l.pagina AND l.estado = 'sigue'),
closed AS (SELECT inicio, min(pagina) AS ciclo, min(inicio) OVER (PARTITION BY min(pagina)) AS x FROM reach
           WHERE inicio IN (SELECT inicio FROM reach r WHERE r.inicio = r.pagina) GROUP BY inicio),
fed AS (SELECT c.ciclo FROM landed l JOIN closed c ON l.siguiente = c.inicio AND l.estado = 'sigue' WHERE l.pagina NOT IN (SELECT inicio FROM closed)),
starts AS (SELECT pagina AS inicio FROM landed
           WHERE pagina NOT IN (SELECT siguiente FROM landed WHERE estado = 'sigue' AND siguiente <> pagina)
           UNION SELECT ciclo FROM closed WHERE ciclo NOT IN (SELECT ciclo FROM fed)),
walk(inicio, posicion, pagina, visto) AS (
  SELECT inicio, 0, inicio, [inicio] FROM starts
  UNION ALL SELECT w.inicio, w.posicion + 1, l.siguiente, list_append(w.visto, l.siguiente)
  FROM walk w JOIN landed l ON w.pagina = l.pagina AND l.estado = 'sigue'
  WHERE NOT list_contains(w.visto, l.siguiente) AND w.posicion + 1 < {limit})
SELECT w.inicio, CAST(w.posicion AS INTEGER) AS posicion, w.pagina,
       CASE WHEN w.posicion < max(w.posicion) OVER (PARTITION BY w.inicio) THEN NULL WHEN l.estado <> 'sigue' THEN l.estado
            WHEN list_contains(w.visto, l.siguiente) THEN 'ciclo' ELSE 'limite' END AS termina
FROM walk w JOIN landed l ON w.pagina = l.pagina
"""

# listings laid over the given pages: those of one site and folder in the order of their addresses. The last page of a listing
# of four or more pages leads back to its first, or into its middle, by the number of pages
_LISTING = r"^[a-zA-Z]+://([^/?#]*/[^/?#]*)"
_LISTING_SQL = r"""WITH RECURSIVE
placed AS (SELECT url, row_number() OVER w AS n, count(*) OVER (PARTITION BY regexp_extract(url, '^[a-zA-Z]+://([^/?#]*/[^/?#]*)', 1)) AS total,
                  lead(url) OVER w AS following, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*/[^/?#]*)', 1) AS listado
           FROM pages WINDOW w AS (PARTITION BY regexp_extract(url, '^[a-zA-Z]+://([^/?#]*/[^/?#]*)', 1) ORDER BY url)),
links AS (SELECT p.url AS pagina, coalesce(p.following, b.url) AS siguiente FROM placed p
          LEFT JOIN placed b ON p.following IS NULL AND p.total >= 4 AND p.listado = b.listado AND b.n = 1 + (p.total % 3)),"""


def _listings(spark, folder):
    # an address landed twice is one page: it does not follow itself
    rows = table(spark, folder, "pages").select("url").distinct().select("url", F.regexp_extract("url", _LISTING, 1).alias("listado"))
    order = Window.partitionBy("listado").orderBy("url")
    placed = rows.select("url", "listado", F.row_number().over(order).alias("n"), F.lead("url").over(order).alias("following"))
    ends = placed.filter("following IS NULL AND n >= 4").select("listado", (1 + F.col("n") % 3).alias("n"), F.lit(True).alias("_end"))
    back = placed.join(ends, ["listado", "n"]).select("listado", F.col("url").alias("back"))
    return placed.join(back, "listado", "left").select(
        F.col("url").alias("pagina"), F.coalesce("following", "back").alias("siguiente"))


@query("page_chains", _LISTING_SQL + _CHAIN_SQL.format(limit=3))
def page_chains(spark, folder):
    """Every start page with its pages in order, up to the page limit."""
    return follow(_listings(spark, folder))


@query("page_chains_whole", _LISTING_SQL + _CHAIN_SQL.format(limit=1_000_000))
def page_chains_whole(spark, folder):
    """Whole chains, up to their end or to the page they have been at before."""
    return follow(_listings(spark, folder), limit=None)


@query("page_chains_markup", r"""WITH RECURSIVE
links AS (SELECT url AS pagina, CASE
            WHEN href IS NULL OR regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
            ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS siguiente
          FROM (SELECT url, CASE WHEN regexp_matches(html, '<li><a href="([^"]*)">[^<]*</a></li></ul>')
                                 THEN regexp_extract(html, '<li><a href="([^"]*)">[^<]*</a></li></ul>', 1) END AS href FROM pages) t),
""" + _CHAIN_SQL.format(limit=3))
def page_chains_markup(spark, folder):
    """Chains along the next links of the landed markup; pages whose next page was not landed say so."""
    every = table(spark, folder, "pages")
    named = pages.next_links(every, _NEXT, ["url"]).select(F.col("url").alias("pagina"), "siguiente")
    return follow(every.select(F.col("url").alias("pagina")).distinct().join(named, "pagina", "left"))


@query("page_next_param", r"""
SELECT page_id, pagina, regexp_replace(url, '([?&]page=)[0-9]+', '\1' || (pagina + 1)) AS siguiente
FROM (SELECT page_id, url, try_cast(regexp_extract(url, '[?&]page=([0-9]+)', 1) AS INTEGER) AS pagina FROM pages) t
WHERE pagina < 3""")
def page_next_param(spark, folder):
    return pages.next_pages(table(spark, folder, "pages"), ["page_id"])


@query("page_block_flag", """
SELECT regexp_matches(lower(html), 'captcha|robot|unusual activity') AS bloqueada, count(*) AS paginas FROM pages GROUP BY 1""")
def page_block_flag(spark, folder):
    return table(spark, folder, "pages").groupBy(pages.blocked().alias("bloqueada")).agg(F.count("*").alias("paginas"))
