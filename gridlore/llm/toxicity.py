"""Severity of toxic text by cumulative-link ordinal regression over hashed words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.features import SAMPLE_ROWS, SLOTS, Sample, adam, sample_of, sparse_rows
from gridlore.llm.common import released, table

#: Grades: 0 clean, 1 mild, 2 severe.
GRADES = 3
#: A text goes from this expected severity on; a text that is surely mild has 1.
REJECT_FROM = 0.25
#: So much above a text without known words at least.
MARGIN = 0.05
STEPS, RATE, DECAY = 150, 0.1, 1e-4
#: Words count whose presence goes with the label by this likelihood ratio (about five standard deviations), in so many rows.
LEAST_RATIO, LEAST_ROWS = 25.0, 5


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - w * x) with one weight vector for all thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """Rows of P(grade > k)."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def _marks(sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """Slots tied to the label, and whether toxic rows have them more often than others."""
    slots, which = np.unique(sample.slots, return_inverse=True)
    toxic = (sample.labels == 1)[sample.rows]
    n, n_bad = float(len(sample.labels)), float(sample.labels.sum())
    rows, bad = np.bincount(which, minlength=len(slots)).astype(float), np.bincount(which[toxic], minlength=len(slots)).astype(float)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    ratio = 2 * (part(bad, rows * n_bad / n) + part(rows - bad, rows * (n - n_bad) / n)
                 + part(n_bad - bad, (n - rows) * n_bad / n) + part(n - n_bad - rows + bad, (n - rows) * (n - n_bad) / n))
    keep = (ratio >= LEAST_RATIO) & (rows >= LEAST_ROWS)
    return slots[keep], (bad * n > rows * n_bad)[keep]


def grades_of(sample: Sample) -> np.ndarray:
    """Ordered grades from labels 0 and 1.

    A toxic row with more distinct words tied to toxicity than the median toxic row is severe. So the grades follow from
    the labels alone.
    """
    if not len(sample.labels) or sample.labels.min() == sample.labels.max():
        return sample.labels.copy()
    slots, more = _marks(sample)
    number = np.bincount(sample.rows[np.isin(sample.slots, slots[more])], minlength=len(sample.labels))
    middle = np.median(number[sample.labels == 1])
    return np.where(sample.labels == 0, 0, np.where(number > middle, 2, 1))


def fit(sample: Sample, steps: int = STEPS) -> OrdinalModel:
    """Maximum likelihood with weight decay over the words tied to the label. Without labelled rows, or with one label only, nothing counts as toxic."""
    if not len(sample.labels) or sample.labels.min() == sample.labels.max():
        return OrdinalModel(np.zeros(SLOTS, np.float32), np.array([20.0, 40.0]))
    grades = grades_of(sample)
    slots, _ = _marks(sample)
    tied = np.isin(sample.slots, slots)
    row, column = sample.rows[tied], np.searchsorted(slots, sample.slots[tied])
    n, width = len(grades), len(slots)
    present = np.arange(GRADES - 1)

    def parts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cuts = x[width] + np.concatenate([[0.0], np.cumsum(np.exp(x[width + 1:]))])
        score = np.bincount(row, weights=x[column], minlength=n)
        below = 1.0 / (1.0 + np.exp(np.clip(score[:, None] - cuts[None, :], -50, 50)))
        return cuts, score, below

    def gradient(x: np.ndarray) -> np.ndarray:
        cuts, _, below = parts(x)
        upper = np.concatenate([below, np.ones((n, 1))], axis=1)[np.arange(n), grades]
        lower = np.concatenate([np.zeros((n, 1)), below], axis=1)[np.arange(n), grades]
        chance = np.maximum(upper - lower, 1e-9)
        slope = below * (1 - below)
        # derivative of -log P(grade) by each threshold
        by_cut = np.zeros_like(below)
        for k in present:
            by_cut[:, k] = np.where(grades == k, -slope[:, k], np.where(grades == k + 1, slope[:, k], 0.0)) / chance
        out = np.zeros_like(x)
        out[:width] = np.bincount(column, weights=-by_cut.sum(axis=1)[row], minlength=width) / n + DECAY * x[:width]
        each = by_cut.mean(axis=0)
        out[width] = each.sum()
        for k in present[1:]:
            out[width + k] = each[k:].sum() * np.exp(x[width + k])
        return out

    start = np.zeros(width + GRADES - 1)
    start[width] = np.log(max((grades == 0).mean(), 1e-3) / max((grades > 0).mean(), 1e-3))
    x = adam(gradient, start, steps, RATE)
    weights = np.zeros(SLOTS, dtype=np.float32)
    weights[slots] = x[:width]
    return OrdinalModel(weights, parts(x)[0])


def score_severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """All columns of ``docs`` with ``severity`` (expected grade), ``p_toxic`` and ``grade`` (the likeliest).

    A null or empty text has no words: its score is that of the thresholds alone. Names already in use are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("severity", "p_toxic", "grade")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            above = [np.zeros((0, GRADES - 1))]
            for offsets, slots in sparse_rows(batch.column(batch.schema.get_field_index("text")), structure=False):
                total = np.concatenate([[0.0], np.cumsum(model.weights[slots], dtype=np.float64)])
                above.append(model.chances(total[offsets[1:]] - total[offsets[:-1]]))
            every = np.concatenate(above)
            chance = np.concatenate([np.ones((len(every), 1)), every], axis=1) - np.concatenate([every, np.zeros((len(every), 1))], axis=1)
            extra = [pa.array(every.sum(axis=1)), pa.array(every[:, 0]), pa.array(chance.argmax(axis=1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "severity", "p_toxic", "grade"])

    return plain.mapInArrow(released(run), f"{schema}, severity double, p_toxic double, grade int")


def toxicity_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fitted on at most ``rows`` labelled documents; labels of 0 and 1 in column ``toxic``."""
    return fit(sample_of(docs, labels, "toxic", structure=False, rows=rows))


def reject_limit(model: OrdinalModel, reject_from: float = REJECT_FROM) -> float:
    """``reject_from``, or more where a text without any known word scores near it: what a model knows nothing about is not toxic to it."""
    return max(reject_from, float(model.chances(np.zeros(1)).sum()) + MARGIN)


def drop_toxic(docs: DataFrame, labels: DataFrame, reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows of ``docs`` whose expected severity is below ``reject_limit``, with the columns of ``docs``."""
    model = toxicity_model(docs, labels)
    taken, own = {c.lower() for c in docs.columns}, {}
    for name in ("severity", "p_toxic", "grade"):  # a user's columns of these names stand aside while rows are scored
        if name in taken:
            own[name] = f"_own_{name}"
            while own[name] in taken:
                own[name] += "_"
    scored = score_severity(docs.withColumnsRenamed(own), model)
    kept = scored.filter(F.col("severity") < reject_limit(model, reject_from))
    return kept.select(*[F.col(own.get(c.lower(), c)).alias(c) for c in docs.columns])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = score_severity(docs, model)
    return scored.select("doc_id", "severity", "p_toxic", "grade", (F.col("severity") >= reject_limit(model)).alias("toxic"))
