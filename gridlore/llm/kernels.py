"""Numpy kernels over the bytes of one Arrow batch: word hashes, shingle sets and blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
#: Odd multipliers of the word and shingle hashes.
BASE = 0x9E3779B97F4A7C15
WORD_WEIGHTS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
_MASK = (1 << 64) - 1


def _table(member) -> np.ndarray:
    return np.array([member(i) for i in range(256)], dtype=bool)


#: Bytes of `[\x20\x09-\x0D]`.
WHITE = _table(lambda i: i == 0x20 or 0x09 <= i <= 0x0D)
#: White space, controls and ASCII punctuation; bytes of multi-byte characters belong to words.
NON_ALNUM = _table(lambda i: i < 128 and not chr(i).isalnum())
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash; a bijection."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        table = np.ones(1, dtype=np.uint64)
        while len(table) < size:
            table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
        out.append(table[:size])
    return out[0], out[1]


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the ``len + 1`` offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    every = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    start = 0
    while start < len(offsets) - 1:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield start, end
        start = end


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(1 << max(20, len(data).bit_length()))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(WORD_WEIGHTS[0]))


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the ``len + 1`` offsets of the rows' words.

    ``data`` holds the rows one after the other. Words are runs of bytes outside ``gaps`` and end with their row. A
    row of many blocks is cut at a gap, so memory grows only with its number of words.
    """
    found: list[np.ndarray] = []
    starts_at: list[np.ndarray] = []
    begin, size = 0, len(data)
    while begin < size:
        end = min(size, begin + BLOCK_BYTES)
        while end < size and not gaps[data[end]]:
            more = np.flatnonzero(gaps[data[end:end + BLOCK_BYTES]])
            end = end + int(more[0]) if len(more) else min(size, end + BLOCK_BYTES)
        piece = data[begin:end]
        solid = np.zeros(len(piece) + 2, dtype=bool)
        solid[1:-1] = ~gaps[piece]
        first = solid[1:-1] & ~solid[:-2]
        last = solid[1:-1] & ~solid[2:]
        cuts = offsets[(offsets > begin) & (offsets < end)] - begin
        first[cuts] = solid[1:-1][cuts]
        last[cuts - 1] = solid[1:-1][cuts - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        found.append(hash_runs(piece, starts, ends))
        starts_at.append(starts + begin)
        begin = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts_at), offsets, side="left")


def shingles(hashes: np.ndarray, n: int = 4) -> np.ndarray:
    """Hashes of all runs of ``n`` words; fewer words are one run, no words none."""
    if len(hashes) == 0:
        return hashes
    length = min(n, len(hashes))
    total = np.full(len(hashes) - length + 1, length, dtype=np.uint64)
    for i in range(length):
        total = total + hashes[i:len(hashes) - length + 1 + i] * np.uint64((WORD_WEIGHTS[i % 4] * (i // 4 * 2 + 1)) & _MASK)
    return mix(total)


def shingle_sets(column: pa.Array, n: int = 4) -> Iterator[np.ndarray]:
    """For every row of a string column its distinct shingles, A-Z lower-cased, sorted by hash."""
    data, offsets = byte_rows(column)
    for first, end in row_blocks(offsets):
        span = LOWER[data[offsets[first]:offsets[end]]]
        hashes, at = words(span, offsets[first:end + 1] - offsets[first])
        for row in range(end - first):
            yield np.unique(shingles(hashes[at[row]:at[row + 1]], n))
