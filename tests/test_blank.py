"""Blank text and what only looks clean."""

from pyspark.sql import functions as F

from gridlore.functions.text import blank_to_null


def test_every_white_space_is_stripped(spark):
    texts = ["a", "a b", " a", "a ", "\u00a0a", "a\u2003", "\ta\n", "\u3000", "", " ", None, "\u00e9", "a\u00e9", "\u00e9 ", "~a~", "!", "\x1fa", "\x7f", "a\x85"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(blank_to_null("t")).collect()]
    assert got == [None if t is None else t.strip() or None for t in texts]


def test_last_character_is_found_without_counting(spark):
    plan = spark.range(1).select(F.col("id").cast("string").alias("t")).select(blank_to_null("t"))._jdf.queryExecution().analyzed().toString()
    assert "right(" not in plan and "as binary" in plan
