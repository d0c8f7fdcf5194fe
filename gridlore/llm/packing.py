"""Best-fit packing of tokenised documents into sequences under several capacities."""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gridlore.llm.common import released, table
from gridlore.llm.kernels import WHITE, byte_rows, hash_runs, row_blocks
from gridlore.session import materialize

TOKENS = 2048
#: Capacities of a sequence: tokens, pieces, and attention cost as the sum of squared lengths.
CAPACITIES = (TOKENS, TOKENS, TOKENS * TOKENS)
WEIGHTS = (1.0, 0.01, 0.01)
#: Pieces packed together by one task.
GROUP = 8192
BLOCK_BYTES = 4 << 20
CACHED_WORDS = 300_000


@lru_cache(maxsize=1)
def _tokenizer(path: str | None):
    """The byte-level BPE of 50,257 ids, from its table of ranks: the ids are those of ``byte_bpe_50k.json``, several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ({}, {})


@lru_cache(maxsize=1)
def _added() -> tuple[dict[bytes, int], re.Pattern[bytes]]:
    """Added tokens of ``byte_bpe_50k.json`` with their ids, and a pattern that finds the longest at a place."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        ids = {token["content"].encode(): token["id"] for token in json.load(file)["added_tokens"]}
    return ids, re.compile(b"|".join(re.escape(token) for token in sorted(ids, key=len, reverse=True)) or b"(?!)")


def _added_edges(span: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where added tokens start and end inside the rows."""
    raw, find = span.tobytes(), _added()[1]
    if not find.search(raw):
        return np.zeros(0, np.int64)
    edges = [edge for a, b in zip(at[:-1].tolist(), at[1:].tolist()) for m in find.finditer(raw, a, b) for edge in m.span()]
    return np.array([edge for edge in edges if edge < len(raw)], dtype=np.int64)


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the text can be cut without changing its ids: at rows, and at a space or line break after no white space.

    The tokenizer never joins white space to what stands before it. After a byte that may end a white-space character of
    several bytes there is no cut.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 3:
        gap = (data == 0x20) | (data == 0x0A)
        before, second, third = data[2:-1], data[1:-2], data[:-3]
        wide = (before >= 0x80) & (((second == 0xC2) & ((before == 0x85) | (before == 0xA0))) | ((third >= 0xE1) & (third <= 0xE3)))
        cut[3:-1] = gap[3:] & ~WHITE[before] & ~wide
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


def token_rows(column: pa.Array, path: str | None = None, added: bool = False, block_bytes: int | None = None) -> Iterator[np.ndarray]:
    """The ids of every row as unsigned 32-bit numbers, closed by id 0. Distinct words of a block are encoded once.

    With ``added`` the strings of added tokens get their own ids, as the tokenizer gives by default; else they are ordinary text.
    Blocks of ``block_bytes`` bound memory: smaller ones, and as much fewer remembered words, cost more time.
    """
    block_bytes = block_bytes or BLOCK_BYTES
    encoding, caches = _tokenizer(path)
    cache, own = caches[added], _added()[0] if added else {}
    data, offsets = byte_rows(column)
    for first, end in row_blocks(offsets, block_bytes):
        span, at = data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        starts = _starts(span, at)
        if added:
            starts = np.union1d(starts, _added_edges(span, at))
        ends = np.append(starts[1:], len(span))
        counts, ids, done = [], [], 0
        while done < len(starts):
            upto = max(done + 1, int(np.searchsorted(ends, starts[done] + block_bytes, side="right")))
            begin = starts[done]
            piece = span[begin:ends[upto - 1]]
            some, their_ends = starts[done:upto] - begin, ends[done:upto] - begin
            hashes, where, which = np.unique(hash_runs(piece, some, their_ends), return_index=True, return_inverse=True)
            keys = hashes.tolist()
            if len(cache) > CACHED_WORDS * min(1.0, block_bytes / BLOCK_BYTES):
                cache.clear()
            values = [cache.get(key) for key in keys]
            raw = piece.tobytes()
            for i, value in enumerate(values):
                if value is None:
                    word = raw[some[where[i]]:their_ends[where[i]]]
                    found = [own[word]] if word in own else encoding.encode_ordinary(word.decode("utf-8", "replace"))
                    values[i] = cache[keys[i]] = np.array(found, dtype="<u4").tobytes()
            lengths = np.array([len(value) >> 2 for value in values], dtype=np.int64)
            flat = np.frombuffer(b"".join(values), dtype="<u4")
            each = lengths[which]
            to = np.cumsum(each)
            offset = (np.cumsum(lengths) - lengths)[which] - (to - each)
            ids.append(flat[np.repeat(offset, each) + np.arange(int(to[-1]))])
            counts.append(each)
            done = upto
        every = np.concatenate(ids) if ids else np.zeros(0, "<u4")
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        rows = total[np.searchsorted(starts, at, side="left")]
        for row in range(end - first):
            yield np.append(every[rows[row]:rows[row + 1]], np.array([0], dtype="<u4"))


def pieces(docs: DataFrame, tokens: int = TOKENS, path: str | None = None, with_ids: bool = False, block_bytes: int | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and on demand ``ids`` (little-endian, 4 bytes each).

    Only documents of more than ``tokens`` ids are cut, all their pieces but the first to the full length. A null or
    empty text is the closing id alone.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), token_rows(batch.column(1), path, added=True, block_bytes=block_bytes), strict=True):
                head = len(ids) % tokens or tokens
                cuts = [0, *range(min(head, len(ids)), len(ids) + 1, tokens)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    raw = ids[a:b].tobytes()
                    out.append((doc, number, a, b - a, zlib.crc32(raw), raw if with_ids else None))
                if len(out) > 20_000:
                    yield _batch(out, schema)
                    out = []
            yield _batch(out, schema)

    schema = pa.schema([("doc_id", batch_type(docs)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary())])
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        released(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


def batch_type(docs: DataFrame) -> pa.DataType:
    return to_arrow_type(docs.schema["doc_id"].dataType)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def best_fit(lengths: np.ndarray, capacities: Sequence[float] = CAPACITIES, weights: Sequence[float] = WEIGHTS,
             by: str = "norm") -> np.ndarray:
    """Bin of every piece; ``lengths`` fall. A piece goes to the bin that holds it under every capacity and fits best.

    ``norm``: the least weighted norm of what is left after the piece. ``dot``: the largest weighted dot product of the
    piece with what is left before it. Ties go to the bin opened first. None fits: a new bin.
    """
    cap, weight = np.asarray(capacities, dtype=float), np.asarray(weights, dtype=float)
    bins = np.zeros(len(lengths), dtype=np.int64)
    least = float(lengths.min()) if len(lengths) else 0.0
    left, number, used = np.zeros((64, 3)), np.zeros(64, dtype=np.int64), 0
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) * length])
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities {tuple(capacities)}")
        best = -1
        if used:
            open_bins = left[:used]
            fits = (open_bins >= need).all(axis=1)
            if fits.any():
                if by == "norm":
                    score = (weight * ((open_bins - need) / cap) ** 2).sum(axis=1)
                else:
                    score = -(weight * (need / cap) * (open_bins / cap)).sum(axis=1)
                best = int(np.argmin(np.where(fits, score, np.inf)))
        if best < 0:
            if used == len(left):
                left, number = np.concatenate([left, np.zeros_like(left)]), np.concatenate([number, np.zeros_like(number)])
            left[used], number[used], best = cap, opened, used
            used, opened = used + 1, opened + 1
        left[best] -= need
        bins[i] = number[best]
        if left[best, 0] < least or left[best, 1] < 1 or left[best, 2] < least * least:  # full: the last keeps its order
            left[best:used - 1], number[best:used - 1] = left[best + 1:used].copy(), number[best + 1:used].copy()
            used -= 1
    return bins


def pack(found: DataFrame, capacities: Sequence[float] = CAPACITIES, weights: Sequence[float] = WEIGHTS, by: str = "norm",
         group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with columns ``doc_id, piece, length``.

    Pieces are dealt by hash into groups of about ``group``; each group is packed by falling length. With thousands of
    pieces a group wastes less than one sequence in a hundred, and no task holds more than its group.
    """
    groups = max(1, -(-found.count() // group))
    keyed = found.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins = best_fit(rows["length"].to_numpy(), capacities, weights, by)
        rows["sequence_id"] = rows["_group"].to_numpy() * (1 << 32) + bins
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows.drop(columns="_group")

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return keyed.groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False, block_bytes: int | None = None, **settings) -> DataFrame:
    """Tokenises ``docs`` (``doc_id, text``) and packs the pieces; repeated rows are packed as often as they stand there."""
    return pack(materialize(pieces(docs, path=path, with_ids=with_ids, block_bytes=block_bytes), "pieces"), **settings)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
