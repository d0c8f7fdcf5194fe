"""Sparse text features for the trained classifiers, and the bounded samples they are fitted on."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.llm.kernels import LOWER, NON_ALNUM, WHITE, byte_rows, row_blocks, words

#: Hashed words fall into this many slots.
WORD_BITS = 18
#: A classifier is fitted on at most so many labelled rows, those of the smallest hash.
SAMPLE_ROWS = 12_000
#: Steps of the structure statistics; every statistic has one slot per step, after the words.
_STEPS = 8
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_SHOUT = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_STATISTICS = 9
#: Slots of words and statistics together.
SLOTS = (1 << WORD_BITS) + _STATISTICS * (_STEPS + 1)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _share_step(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for none, then the powers of two from 1/128 of the whole up."""
    share = part / np.maximum(whole, 1)
    return np.where(part == 0, 0, np.clip(np.floor(np.log2(np.maximum(share, 1e-9) * 128)) + 1, 1, _STEPS).astype(np.int64))


def _statistics(span: np.ndarray, at: np.ndarray, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Steps of each row's statistics: symbols, capitals, digits, shouting, repeated words, repeated lines, words, word length."""
    size = at[1:] - at[:-1]
    solid = _per_row(~WHITE[span], at)
    n_words = rows[1:] - rows[:-1]
    repeated = np.zeros(len(size), np.int64)
    for row in range(len(size)):
        own = hashes[rows[row]:rows[row + 1]]
        if len(own) > 8:  # runs of three words
            runs = own[:-2] * np.uint64(3) + own[1:-1] * np.uint64(5) + own[2:] * np.uint64(7)
            repeated[row] = len(runs) - len(np.unique(runs))
    breaks = _per_row(span == 0x0A, at)
    length = np.clip(solid // np.maximum(n_words, 1), 0, _STEPS)
    return np.stack([
        _share_step(_per_row(_SYMBOLS[span], at), solid), _share_step(_per_row(_UPPER[span], at), solid),
        _share_step(_per_row(_DIGIT[span], at), solid), _share_step(_per_row(_SHOUT[span], at), solid),
        _share_step(repeated, n_words), _share_step(breaks, n_words),
        np.clip(np.log2(n_words + 1).astype(np.int64) // 2, 0, _STEPS), length], axis=1)


def _length_step(lengths: pa.Array | None, n: int) -> np.ndarray:
    """Metadata: the recorded length in steps of two doublings, 0 where it is null or absent."""
    if lengths is None:
        return np.zeros(n, np.int64)
    known = lengths.cast(pa.int64()).fill_null(-1).to_numpy()
    return np.where(known < 0, 0, np.clip(np.log2(np.maximum(known, 0) + 1).astype(np.int64) // 2 + 1, 1, _STEPS))


def sparse_rows(column: pa.Array, structure: bool, lengths: pa.Array | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of rows: the offsets of their features and the features' slots, each slot once per row.

    Words are lower-cased runs without ASCII punctuation. With ``structure`` the steps of the statistics and of the
    recorded ``lengths`` follow; then even an empty or null text has features.
    """
    data, offsets = byte_rows(column)
    for first, end in row_blocks(offsets):
        raw = data[offsets[first]:offsets[end]]
        at = offsets[first:end + 1] - offsets[first]
        hashes, rows = words(LOWER[raw], at, NON_ALNUM)
        key = (np.repeat(np.arange(end - first, dtype=np.int64), np.diff(rows)) << 32) | (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        if structure:
            recorded = _length_step(lengths.slice(first, end - first) if lengths is not None else None, end - first)
            steps = np.concatenate([_statistics(raw, at, hashes, rows), recorded[:, None]], axis=1)
            slots = (1 << WORD_BITS) + np.arange(_STATISTICS) * (_STEPS + 1) + steps
            key = np.concatenate([key, ((np.arange(end - first, dtype=np.int64) << 32)[:, None] | slots).ravel()])
        key = np.unique(key)
        yield np.searchsorted(key, np.arange(end - first + 1, dtype=np.int64) << 32), key & 0xFFFFFFFF


@dataclass
class Sample:
    """Features of labelled rows: row ``i`` has the slots ``slots[offsets[i]:offsets[i + 1]]``."""

    offsets: np.ndarray
    slots: np.ndarray
    labels: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.labels)), np.diff(self.offsets))


def recorded_length(docs: DataFrame) -> Column:
    return (F.col("n_chars").try_cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")).alias("_length")


def sample_of(docs: DataFrame, labels: DataFrame, label: str, structure: bool, rows: int = SAMPLE_ROWS, where: Column | None = None) -> Sample:
    """Features of at most ``rows`` labelled documents, chosen by the hash of their ids.

    Labels without an id or value do not count; of documents that share an id the one of the least hash counts. Sampled features are some kilobytes a row, so the sample fits the driver.
    """
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    if where is not None:
        marked = marked.filter(where)
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for offsets, slots in sparse_rows(batch.column(1), structure, batch.column(2)):
                n = len(offsets) - 1
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, n), batch.column(3).slice(start, n).cast(pa.int32()), lists],
                                                 names=["doc_id", "label", "slots"])
                start += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    row = F.struct("text", recorded_length(docs)).alias("row")
    asked = docs.select("doc_id", row).join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min_by("row", F.xxhash64("row")).alias("row"), F.first("_label").alias("_label"))
    found = asked.select("doc_id", "row.text", "row._length", "_label").mapInArrow(run, f"doc_id {kind}, label int, slots array<int>").toArrow()
    found = found.sort_by("doc_id").combine_chunks()
    lists = found["slots"].combine_chunks() if found.num_rows else None
    if lists is None:
        return Sample(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    lengths = np.diff(lists.offsets.to_numpy().astype(np.int64))
    return Sample(np.concatenate([[0], np.cumsum(lengths)]), lists.flatten().to_numpy().astype(np.int64),
                  found["label"].to_numpy().astype(np.int64))


def compact(sample: Sample, least: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots that ``least`` rows or more have, and row and column of every remaining feature."""
    slots, which, count = np.unique(sample.slots, return_inverse=True, return_counts=True)
    keep = count >= least
    column = np.cumsum(keep) - 1
    stay = keep[which]
    return slots[keep], sample.rows[stay], column[which][stay]


def adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam from ``start``; ``gradient`` takes and returns a flat array."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        x -= rate * (1 - 0.5 * t / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return x
