"""Keyword tables walked as automata, against a search for every keyword."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlore.functions import automaton, text

WORDS = "orden int, categoria string, palabra string"


def by_force(value, rules, default="Otra"):
    hits = [(o is None, o or 0, c) for o, c, w in rules if value is not None and w is not None and c is not None and w in value.lower()]
    return min(hits)[2] if hits else default


def assert_as_by_force(spark, texts, rules, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = automaton.classify_by_table(df, "t", spark.createDataFrame(rules, WORDS), **settings)
    assert {r["id"]: r["categoria"] for r in got.collect()} == {i: by_force(t, rules) for i, t in enumerate(texts)}


@pytest.mark.parametrize("most_cells", [automaton.MOST_CELLS, 40])
def test_random_keywords(spark, most_cells):
    rng = np.random.default_rng(5)
    def some(n, letters="abé𝄞 "):
        return "".join(rng.choice(list(letters), n))
    rules = [(int(rng.integers(0, 6)), f"c{rng.integers(0, 4)}", some(int(rng.integers(2, 7)))) for _ in range(25)]
    texts = [None, "", *[some(int(n)) for n in rng.integers(1, 25, 60)], some(20_000, "b"), "zzz" + rules[0][2].upper() + "ñ"]
    assert_as_by_force(spark, texts, rules, most_cells=most_cells)


def test_ends_inside_other_keywords(spark):
    rules = [(2, "long", "abcdef"), (1, "inner", "cd"), (3, "last", "f"), (1, "also", "cd"), (None, "none", "q"), (0, None, "x"), (0, "y", None)]
    assert_as_by_force(spark, ["abcdef", "abcxef", "abcde", "f", "q", "x", "aabcdef", "CD"], rules)


def test_empty_keyword_and_empty_table(spark):
    assert_as_by_force(spark, [None, "", "a"], [(5, "all", ""), (1, "a", "a")])
    assert_as_by_force(spark, [None, "", "a"], [])


def test_equals_the_fixed_categories(spark):
    rules = [(i, c, w) for i, (c, words) in enumerate(text.CATEGORY_KEYWORDS) for w in words]
    df = spark.createDataFrame([("Solar Thermal",), ("Natural Gas and hydro",), ("Pumped Storage coal",), ("none",), (None,)], "t string")
    got = automaton.classify_by_table(df, "t", spark.createDataFrame(rules, WORDS)).withColumn("fixed", text.classify("t"))
    assert got.filter(~F.col("categoria").eqNullSafe(F.col("fixed"))).isEmpty()
