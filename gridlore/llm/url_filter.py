"""URL rules whose block decisions reach aliases over redirect and canonical-link edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import table
from gridlore.llm.components import components
from gridlore.session import materialize

#: Verdict and host/path of each rule.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

#: Tags that name another address of the same page: canonical links, their social-media form and refresh redirects.
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_IS_CANONICAL = r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b"
_IS_OG = r"(?is)^<meta\b.*\bproperty\s*=\s*[\"']?og:url\b"
_IS_REFRESH = r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_CONTENT = r"(?is)\bcontent\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, slash, rest = rule.partition("/")
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule that fits, else null. Rules are configuration: they become one expression, so keep them to some hundreds."""
    longest = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r[0]))
    return F.coalesce(*[F.when(_fits(rule, host, path), F.lit(rule)) for _, rule in longest], F.lit(None).cast("string"))


def address(url: Column) -> Column:
    """What tells pages apart: host, path and query, without scheme and fragment; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def _resolved(target: Column, url: Column) -> Column:
    """A link against the page's own address: absolute, without scheme, from the root, or beside the page."""
    target = F.regexp_replace(F.trim(target), "&amp;", "&")
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    beside = F.concat(root, F.regexp_replace(F.when(path_of(url) == "", "/").otherwise(path_of(url)), "[^/]*$", ""))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, target))
            .when(target.startswith("?") | target.startswith("#"), F.concat(root, path_of(url), target))
            .otherwise(F.concat(beside, target)))


def alias_links(pages: DataFrame) -> DataFrame:
    """``url, target`` of every canonical link, og:url and refresh redirect in a page's markup."""
    html = F.coalesce(F.col("html"), F.lit(""))
    # pages without any such word are not searched tag by tag
    tags = F.when(html.rlike("(?i)canonical|og:url|http-equiv"), F.regexp_extract_all(html, F.lit(_TAG), F.lit(0)))
    found = pages.filter(F.col("url").contains("://")).select("url", F.explode(tags).alias("tag"))
    target = (F.when(F.col("tag").rlike(_IS_CANONICAL), F.regexp_extract("tag", _HREF, 1))
              .when(F.col("tag").rlike(_IS_OG), F.regexp_extract("tag", _CONTENT, 1))
              .when(F.col("tag").rlike(_IS_REFRESH), F.regexp_extract("tag", _REFRESH_URL, 1)))
    links = found.select("url", target.alias("target")).filter(F.col("target") != "")
    return links.select("url", _resolved(F.col("target"), F.col("url")).alias("target"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_class`` for every row of ``pages`` (``page_id, url, html``).

    A rule fits a host and its subdomains where the path starts with the rule's; the longest wins and its verdict is
    final. Pages without a rule are blocked when a blocked address is connected with theirs over canonical links, refresh
    redirects or ``redirects`` (``url, target``, such as a crawler's log), else allowed. An address that a rule allows stays
    allowed whatever its aliases are. Linked addresses count though no page has them. A null url or one without ``://``
    has no aliases. ``alias_class`` is the least address of the class, null without one.
    """
    links = alias_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").filter("url is not null and target is not null"))
    links = materialize(links, "alias-links")
    ends = links.select(F.col("url").alias("link")).unionByName(links.select(F.col("target").alias("link")))
    named = ends.filter(F.col("link").contains("://"))
    edges = links.select(address(F.col("url")).alias("u"), address(F.col("target")).alias("v")).na.drop()
    classes = components(edges)

    verdicts = {rule: verdict for verdict, rule in rules}
    blocked_rules = [rule for rule, verdict in verdicts.items() if verdict == "block"]
    rule = rule_of(rules, host_of(F.col("link")), path_of(F.col("link")))
    blocked = (named.select(address(F.col("link")).alias("node"), rule.alias("rule"))
               .filter(F.col("rule").isin(blocked_rules)).select("node").distinct().join(classes, "node")
               .select("component").distinct())
    blocked_nodes = materialize(classes.join(materialize(blocked, "blocked").withColumn("blocked", F.lit(True)), "component", "left"),
                                "alias-verdicts")

    url = F.col("url")
    own = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("node"))
    own = own.withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    ruled = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in verdicts.items()], F.lit(None).cast("string"))
    return own.join(blocked_nodes, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce(ruled, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("component", "node").alias("alias_class"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


# The markup of these pages has no canonical links, so the SQL holds the rules alone; links are tested on small pages.
SQL = r"""
WITH p AS (
  SELECT page_id,
    coalesce(regexp_replace(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^$', ''), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')),
m AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM p JOIN r ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id
"""
