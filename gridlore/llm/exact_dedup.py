"""Exact duplicates: groups of one 128-bit content hash whose bytes are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import may_hold, salt_of, table, text_of, unused, without_white
from gridlore.session import materialize


def content_hash(text: Column) -> Column:
    """128 bits as binary(16)."""
    return F.unhex(F.md5(text))


def _rank() -> Column:
    """Smallest for the row that stays: most code points, then smallest id of any ordered type; a null id comes last."""
    return F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"),
                    F.col("text_sha256").alias("sha"))


def _hashed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = text_of()
    plain = docs.select(F.col("doc_id"), F.char_length(text).cast("long").alias("n_points"), without_white(text).alias("norm"))
    return plain.select("doc_id", "n_points", "norm", digest(F.col("norm")).alias("h"),
                        F.sha2(F.col("norm"), 256).alias("text_sha256"))


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``n`` (rows of the group) and ``top`` (rank of the row that stays); a hot group is spread over salts."""
    parts = rows.groupBy(*keys, "salt").agg(F.sum("times").alias("n"), F.min("rank").alias("top"))
    whole = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("top").alias("top"))
    # a key meets its total in at most one row per salt
    return parts.select(*keys, "salt").join(whole, keys)


def _answer(rows: DataFrame) -> DataFrame:
    best = F.col("rank") == F.col("top")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        "doc_id", F.col("top.id").alias("keep_id"),
        F.col("n").alias("group_size"), (best & (F.col("copy") == 1)).alias("kept"), "text_sha256", "h", "n_points")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and the hash ``h``.

    Texts are equal when identical without white space; null counts as empty. Of equal texts the row with the most
    code points stays, then the one with the smallest ``doc_id``, of whatever ordered type; a null id comes last. Of whole rows repeated, one stays. Rows
    are grouped by ``digest``; then every row's text is compared with that of the row that stays, and texts that
    differ although their hashes agree are grouped by the text itself.
    """
    spark = docs.sparkSession
    thin = materialize(
        _hashed(docs, digest).groupBy("h", "text_sha256", "doc_id", "n_points").agg(F.count("*").alias("times"))
        .withColumn("salt", salt_of(spark, "doc_id")).withColumn("rank", _rank()), "hashed")
    groups = materialize(_groups(thin, ["h"]), "groups")
    rows = thin.join(groups, ["h", "salt"])

    shared = groups.filter("n > 1")
    # only texts that have company are shuffled
    company = thin.join(shared.select("h", "salt"), ["h", "salt"], "left_semi")
    members = materialize(
        _hashed(docs.filter(may_hold(company)), digest).withColumn("salt", salt_of(spark, "doc_id"))
        .join(shared, ["h", "salt"]).withColumn("rank", _rank()), "members")
    kept_text = members.filter("rank = top").groupBy("h").agg(F.max("norm").alias("kept_norm"))
    asked = shared.select("h", "salt").join(materialize(kept_text, "kept-text"), "h")
    differing = materialize(
        members.join(asked, ["h", "salt"]).filter("norm <> kept_norm")
        .groupBy("h", "norm", "text_sha256", "doc_id", "n_points", "salt", "rank").agg(F.count("*").alias("times")), "collisions")
    if differing.isEmpty():
        return _answer(rows)
    key = ["h", "text_sha256", "doc_id", "n_points"]
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    agreeing = thin.alias("a").join(differing.alias("b"), same, "left_anti")
    first = agreeing.join(materialize(_groups(agreeing, ["h"]), "groups"), ["h", "salt"])
    others = differing.join(materialize(_groups(differing, ["h", "norm"]), "groups"), ["h", "norm", "salt"]).drop("norm")
    return _answer(first).unionByName(_answer(others))


def drop_copies(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows repeated with id and text one stays."""
    name = unused(docs, "_key")
    key = ["doc_id", "text_sha256", "n_points"]
    rows = exact_groups(docs, digest).groupBy(*key).agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    marks = materialize(rows.filter("not kept or rows > 1"), "marks")
    doubtful = may_hold(marks)  # no other row needs its text shuffled
    marked = docs.filter(doubtful).select("*", F.struct(
        F.col("doc_id"), F.sha2(without_white(text_of()), 256).alias("text_sha256"),
        F.char_length(text_of()).cast("long").alias("n_points")).alias(name))
    same = [F.col(f"d.{name}.{k}").eqNullSafe(F.col(f"m.{k}")) for k in key]
    stay = marked.alias("d").join(marks.alias("m"), same, "left_anti")
    repeated = marks.filter("kept")
    if not repeated.isEmpty():
        stay = stay.unionByName(marked.alias("d").join(repeated.alias("m"), same, "left_semi").dropDuplicates([name]))
    return docs.filter(~doubtful).union(stay.drop(name))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept,
  sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST)
"""
