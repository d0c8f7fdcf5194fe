"""Extraction from landed HTML: titles, repeated elements, cards, links and block notices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.functions.text import strip

# fixed values: notices that mean the site refused the request
BLOCK_NOTICES = ["captcha", "robot", "unusual activity"]
# fixed value: pages followed from one start page
PAGE_LIMIT = 3


def title(html: str = "html") -> Column:
    return F.regexp_extract(html, r"<title>([^<]*)</title>", 1)


def element_texts(df: DataFrame, tag: str, keep: Sequence[str], html: str = "html") -> DataFrame:
    """Trimmed text of every such element that holds plain text, with its place on the page."""
    found = F.regexp_extract_all(F.col(html), F.lit(rf"<{tag}(?:\s[^>]*)?>([^<]*)</{tag}>"), F.lit(1))
    return (df.select(*keep, F.posexplode(found).alias("posicion", "texto"))
            .withColumn("texto", strip("texto")))


def cards(df: DataFrame, card: str, fields: dict[str, str], keep: Sequence[str], first: int | None = None,
          html: str = "html") -> DataFrame:
    """One row per card. ``card`` is a pattern whose first group is the card's markup; each field has a pattern
    matched inside it, null where it does not match. ``first`` keeps the leading cards of a page."""
    blocks = F.regexp_extract_all(F.col(html), F.lit(card), F.lit(1))
    if first is not None:
        blocks = F.slice(blocks, 1, first)
    rows = df.select(*keep, F.posexplode(blocks).alias("posicion", "_card"))
    return rows.select(*keep, "posicion", *[
        F.when(F.col("_card").rlike(pattern),
               strip(F.regexp_extract("_card", pattern, 1))).alias(name)
        for name, pattern in fields.items()])


def prefer(*choices: Column) -> Column:
    """First choice that is neither null nor blank: an attribute before a text that may be cut off."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def split_rejects(df: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all needed fields, and the others."""
    whole = F.forall(F.array(*[F.col(c).isNotNull() & (F.col(c) != "") for c in needed]),
                     lambda ok: F.coalesce(ok, F.lit(False)))
    return df.filter(whole), df.filter(~whole)


def _without_dots(path: Column) -> Column:
    """Path with its ``.`` and ``..`` segments applied."""
    parts = F.aggregate(
        F.split(path, "/"), F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done))
        .otherwise(F.array_append(done, part)))
    ends_in_folder = path.rlike(r"(^|/)\.\.?$")
    return F.concat(F.array_join(parts, "/"), F.when(ends_in_folder, "/").otherwise(""))


def _tidy(address: Column) -> Column:
    """Applies dot segments to the path of an absolute address that has any."""
    pattern = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
    whole = F.concat(F.regexp_extract(address, pattern, 1), _without_dots(F.regexp_extract(address, pattern, 2)),
                     F.regexp_extract(address, pattern, 3))
    return F.when(address.rlike(r"://[^?#]*/\.\.?(/|$|[?#])"), whole).otherwise(address)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page ``base``."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(site, F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", "")))
    return _tidy(F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(site, href))
            .when(href.startswith("?"), F.concat(site, path, href))
            .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
            .when(href == "", base)
            .otherwise(F.concat(folder, href)))


def page_links(df: DataFrame, keep: Sequence[str], url: str = "url", html: str = "html") -> DataFrame:
    """Every link of a page with its resolved address."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return (df.select(*keep, url, F.posexplode(found).alias("posicion", "href"))
            .select(*keep, "posicion", "href", resolve_link(F.col(url), F.col("href")).alias("destino")))


def next_links(df: DataFrame, pattern: str, keep: Sequence[str], url: str = "url", html: str = "html") -> DataFrame:
    """Pages that name a following page, with its resolved address; ``pattern``'s first group is the link."""
    found = F.regexp_extract(html, pattern, 1)
    return (df.filter(F.col(html).rlike(pattern))
            .select(*keep, resolve_link(F.col(url), found).alias("siguiente")))


def next_pages(df: DataFrame, keep: Sequence[str], limit: int = PAGE_LIMIT, url: str = "url") -> DataFrame:
    """The following page of a numbered listing, while the page limit is not reached."""
    number = F.regexp_extract(url, r"[?&]page=([0-9]+)", 1).try_cast("int")
    return (df.select(*keep, url, number.alias("pagina"))
            .filter(F.col("pagina").isNotNull() & (F.col("pagina") < limit))
            .select(*keep, "pagina", F.concat(
                F.regexp_extract(url, r"^(.*[?&]page=)[0-9]+", 1), (F.col("pagina") + 1).cast("string"),
                F.regexp_extract(url, r"[?&]page=[0-9]+(.*)$", 1)).alias("siguiente")))


def blocked(html: str = "html", notices: Sequence[str] = tuple(BLOCK_NOTICES)) -> Column:
    text = F.lower(F.col(html))
    hit = text.contains(notices[0])
    for notice in notices[1:]:
        hit = hit | text.contains(notice)
    return hit


def stamp(df: DataFrame, group: str, captured: str) -> DataFrame:
    """Group and capture time as given: a job repeated with the same arguments writes the same rows."""
    return df.withColumns({"grupo": F.lit(group), "fecha_captura": F.lit(captured)})
