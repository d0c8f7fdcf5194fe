"""Training-text pipeline: toxicity, exact copies, near copies, mixing of sources, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlore.llm.common import table
from gridlore.llm.exact_dedup import drop_copies
from gridlore.llm.jaccard_join import drop_near_copies
from gridlore.llm.mixing import take
from gridlore.llm.packing import pack_documents
from gridlore.llm.toxicity import drop_toxic
from gridlore.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word runs at 80 percent."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return take(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2,048 tokens."""
    return pack_documents(docs, block_bytes=1 << 16)  # the executors still hold what earlier stages left


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: The fitted model, the reachability of near copies and the packing have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs, name)
    return docs
