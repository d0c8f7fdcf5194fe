"""Queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query, module; the query is a function of that name.
_OPERATORS = {
    "op1_ngram_jaccard_join": "jaccard_join",
    "op2_quality_rules": "quality_rules",
    "op3_toxicity": "toxicity",
    "op4_source_mixing": "mixing",
    "op5_best_fit_packing": "packing",
    "op6_url_filter": "url_filter",
    "op7_fuzzy_line_dedup": "line_dedup",
    "op8_exact_dedup": "exact_dedup",
    "op9_secret_scan": "secrets",
    "op10_quality_classifier": "quality_model",
    "op11_cross_tokenizer_alignment": "cross_align",
    "op12_hard_negatives": "hard_negatives",
    "op13_orc_tokens": "token_files",
}


def _module(name: str):
    return import_module(f"gridlore.llm.{_OPERATORS[name]}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(_module(name), name) for name in _OPERATORS} | {"pipeline": import_module("corpus_pipeline").run}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(_module(name), "SQL", None) for name in _OPERATORS}
    found["pipeline"] = import_module("corpus_pipeline").ORACLE_SQL
    return {name: sql for name, sql in found.items() if sql}
