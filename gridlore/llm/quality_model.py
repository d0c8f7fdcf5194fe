"""Quality classifier: a factorisation machine over hashed words, structure statistics and the recorded length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import table, unused
from gridlore.llm.features import SLOTS, WORD_BITS, Sample, adam, compact, recorded_length, sample_of, sparse_rows

RANK = 4
#: The model is fitted on at most so many labelled rows, those of the smallest hash; the driver holds some 100 kB for each.
SAMPLE_ROWS = 4_000
STEPS, RATE, DECAY = 120, 0.05, 1e-3
#: Weight of a word against a statistic, so that hundreds of words do not drown the nine statistics.
WORD_VALUE = 0.05
FOLDS, HELD_OUT = 3, 1


@dataclass
class FactorModel:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _values(slots: np.ndarray) -> np.ndarray:
    return np.where(slots < (1 << WORD_BITS), WORD_VALUE, 1.0)


def _sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(row, weights=values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


def fit(sample: Sample, rank: int = RANK, steps: int = STEPS) -> FactorModel:
    """Logistic loss with weight decay. Without labelled rows every score is 0.5; with one label only it is that label's."""
    weights, factors = np.zeros(SLOTS, np.float32), np.zeros((SLOTS, rank), np.float32)
    if not len(sample.labels) or sample.labels.min() == sample.labels.max():
        return FactorModel(0.0 if not len(sample.labels) else float(6 * sample.labels[0] - 3), weights, factors)
    slots, row, column = compact(sample)
    n, width, value = len(sample.labels), len(slots), _values(slots)
    mean = sample.labels.mean()

    def gradient(x: np.ndarray) -> np.ndarray:
        w, v = x[1:width + 1], x[width + 1:].reshape(width, rank)
        scaled = v[column] * value[column, None]
        sums = _sums(row, scaled, n)
        pairs = 0.5 * ((sums ** 2).sum(axis=1) - np.bincount(row, weights=(scaled ** 2).sum(axis=1), minlength=n))
        score = x[0] + np.bincount(row, weights=w[column] * value[column], minlength=n) + pairs
        error = (1.0 / (1.0 + np.exp(-np.clip(score, -50, 50))) - sample.labels) / n
        out = np.empty_like(x)
        out[0] = error.sum()
        out[1:width + 1] = np.bincount(column, weights=error[row] * value[column], minlength=width) + DECAY / n * w
        inner = error[row, None] * value[column, None] * (sums[row] - scaled)
        out[width + 1:] = (_sums(column, inner, width) + DECAY / n * v).ravel()
        return out

    start = np.concatenate([[np.log(mean / (1 - mean))], np.zeros(width),
                            np.random.default_rng(7).normal(0, 0.02, width * rank)])
    x = adam(gradient, start, steps, RATE)
    weights[slots], factors[slots] = x[1:width + 1], x[width + 1:].reshape(width, rank)
    return FactorModel(float(x[0]), weights, factors)


def _scores(model: FactorModel, offsets: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Linear time: half of the squared sums less the sums of squares gives all pairs."""
    value = _values(slots)
    scaled = model.factors[slots].astype(np.float64) * value[:, None]
    columns = np.concatenate([(model.weights[slots] * value)[:, None], (scaled ** 2).sum(axis=1)[:, None], scaled], axis=1)
    total = np.concatenate([np.zeros((1, columns.shape[1])), np.cumsum(columns, axis=0)])
    sums = total[offsets[1:]] - total[offsets[:-1]]
    score = model.bias + sums[:, 0] + 0.5 * ((sums[:, 2:] ** 2).sum(axis=1) - sums[:, 1])
    return 1.0 / (1.0 + np.exp(-np.clip(score, -50, 50)))


def score_quality(docs: DataFrame, model: FactorModel) -> DataFrame:
    """All columns of ``docs`` with ``score`` from 0 to 1, which replaces a column of that name; a null or empty text is scored by its statistics."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("score")
    asked = plain.select("*", recorded_length(plain).alias(unused(plain, "_length")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [np.zeros(0)]
            for offsets, slots in sparse_rows(batch.column(batch.schema.get_field_index("text")), True, batch.column(batch.num_columns - 1)):
                found.append(_scores(model, offsets, slots))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found))], names=[*batch.schema.names[:-1], "score"])

    return asked.mapInArrow(run, f"{schema}, score double")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 1 by 3; a null id is not held out, as no label has it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> FactorModel:
    """Fitted on at most ``rows`` labelled documents that are not held out; labels of 0 and 1 in column ``quality``."""
    return fit(sample_of(docs, labels, "quality", structure=True, rows=rows, where=~held_out(F.col("doc_id"))))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
