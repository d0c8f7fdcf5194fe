"""Line-first cleaning: lines are judged one by one, then the document by what it lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import WORD, table, text_of, without_white

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A line with more symbols than this share of its characters, in percent, goes.
MAX_SYMBOL_PERCENT = 10
#: A document that loses more than this share of its word characters, in percent, goes.
MAX_LOST_PERCENT = 40

#: A sentence end, also before closing quotes and brackets, inside the line or at its end: a paragraph may be cut off.
_SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|$)"
#: Menus: three or more short entries between bars, bullets or angle marks, or a lone menu word.
_NAVIGATION = (r"^[\x20\x09-\x0D]*(?:[^|•·»>]{1,40}[|•·»>]){3,}[^|•·»>]{0,40}$"
               r"|(?i)^[\x20\x09-\x0D]*(?:home|menu|login|log in|sign in|sign up|search|next|previous|share|back to top)[\x20\x09-\x0D.]*$")
_BOILERPLATE = (r"(?i)\b(?:lorem ipsum|all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|enable javascript"
                r"|subscribe to our newsletter|click here)\b")


def _count_of(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``_lines`` to the rows of ``docs``.

    A null text counts as empty. Words of repeated windows count once each, the first occurrence included; windows are
    told apart by a 64-bit hash of their words.
    """
    text = text_of()
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumn("_words", words).withColumn("_lines", F.split(text, "\n"))
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    count = F.size("_words")
    window = F.transform(F.sequence(F.lit(0), count - WINDOW),
                         lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("_windows", F.when(count >= WINDOW, window))
    # most texts repeat no window: only the others are sorted
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    rows = rows.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))

    def twice(window: Column, i: Column) -> Column:
        before = F.get(F.col("_sorted"), i - 1).getField("h")
        after = F.get(F.col("_sorted"), i + 1).getField("h")
        return (F.coalesce(before == window["h"], F.lit(False)) | F.coalesce(after == window["h"], F.lit(False)))

    rows = rows.withColumn("_starts", F.array_sort(F.transform(F.filter("_sorted", twice), lambda w: w["at"])))
    covered = F.aggregate("_starts", F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")), lambda a, at: F.struct(
        (a["sum"] + F.least(F.lit(WINDOW), at - a["last"])).alias("sum"), at.alias("last")))
    solid = F.filter("_lines", lambda line: line.rlike(WORD))
    return rows.withColumns({
        "n_words": count.cast("long"),
        "word_chars": F.char_length(without_white(text)).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_dup_lines": F.size(solid).cast("long") - F.size(F.array_distinct(solid)),
        "n_repeat_words": F.coalesce(covered["sum"], F.lit(0)).cast("long"),
    }).drop("_words", "_hashes", "_windows", "_sorted", "_starts")


_STEPS = {"_words", "_lines", "_hashes", "_windows", "_sorted", "_starts", "_kept"}


def line_fails(line: Column) -> Column:
    """Whether a line with words goes: no sentence end, too many symbols, a menu, or boilerplate."""
    symbols = F.char_length(line) - F.char_length(F.translate(line, SYMBOLS, ""))
    return (~line.rlike(_SENTENCE_END) | (100 * symbols > MAX_SYMBOL_PERCENT * F.char_length(line))
            | line.rlike(_NAVIGATION) | line.rlike(_BOILERPLATE))


def clean_lines(docs: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """The rows of ``docs`` with the base counts, ``clean_text``, ``n_lines_removed``, ``lost_chars``, ``base_failed`` and ``kept``,
    which replace columns of these names.

    Lines without a word stay as they are. A document goes when it fails the base rules or loses more than
    ``max_lost_percent`` of its word characters; an empty or null text has no words, so it fails the base rules.
    """
    # own columns with the names of steps step aside
    own = {c: f"own{i}_{c}" for i, c in enumerate(docs.columns) if c.lower() in _STEPS}
    rows = base_counts(docs.withColumnsRenamed(own))
    rows = rows.withColumn("_kept", F.filter("_lines", lambda line: ~(line.rlike(WORD) & line_fails(line))))
    clean = F.array_join("_kept", "\n")
    rows = rows.withColumn("clean_text", clean).withColumn("n_lines_removed", (F.size("_lines") - F.size("_kept")).cast("long"))
    rows = rows.withColumn("lost_chars", F.col("word_chars") - F.char_length(without_white(F.col("clean_text"))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("word_chars"))).drop("_lines", "_kept").withColumnsRenamed({aside: c for c, aside in own.items()})


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "lost_chars")


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  string_split(t, chr(10)) AS lines FROM d),
win AS (SELECT doc_id, i, words[i:i + 4] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
l AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS solid FROM w),
c AS (SELECT *, list_filter(lines, lambda x: NOT (regexp_matches(x, '[^\x20\x09-\x0D]') AND (
    NOT regexp_matches(x, '[.!?…。！？]["''”’»)\]]*(?:[\x20\x09-\x0D]|$)')
    OR 100 * (length(x) - length(translate(x, '{SYMBOLS}', ''))) > {MAX_SYMBOL_PERCENT} * length(x)
    OR regexp_matches(x, '{_NAVIGATION}') OR regexp_matches(x, '{_BOILERPLATE}')))) AS stay FROM l),
f AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
  len(solid) - len(list_distinct(solid)) AS n_dup_lines, len(lines) - len(stay) AS n_lines_removed,
  length(regexp_replace(list_aggregate(list_concat([''], stay), 'string_agg', chr(10)), '[\x20\x09-\x0D]', '', 'g')) AS left_chars FROM c),
b AS (SELECT f.*, coalesce(rep.n, 0) AS n_repeat_words FROM f LEFT JOIN rep ON f.doc_id = rep.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND 100 * (word_chars - left_chars) <= {MAX_LOST_PERCENT} * word_chars AS kept,
  n_lines_removed, word_chars - left_chars AS lost_chars
FROM b
"""
