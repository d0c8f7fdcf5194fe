"""Keyword tables of any size as automata: one pass over a text finds its first category, whatever the number of keywords."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.functions.text import DEFAULT_CATEGORY

#: Cells of one automaton's transition table, 4 bytes each on every executor; longer keyword tables are walked as several automata.
MOST_CELLS = 4_000_000
#: Rank of a text without a keyword.
NONE = 2**31 - 1
#: Bytes of a lane: texts are cut into lanes that are walked side by side; and bytes walked at once.
LANE, BLOCK = 512, 1 << 22


def _parts(words: Sequence[tuple[bytes, int]], most_cells: int) -> Iterator[list[tuple[bytes, int]]]:
    """The sorted keywords cut so that states times letters stays within ``most_cells``; a longer keyword is a part of its own."""
    part, states, letters, before = [], 1, set(), b""
    for word, rank in words:
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        if part and (states + len(word) - shared) * (len(letters | set(word)) + 1) > most_cells:
            yield part
            part, states, letters, shared = [], 1, set(), 0
        part.append((word, rank))
        states, before = states + len(word) - shared, word
        letters |= set(word)
    if part:
        yield part


def transitions(words: Sequence[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every byte, next state by ``state * classes + class``, and the least rank found in every state.

    A state stands for the longest end of the bytes read that begins a keyword; class 0 holds all bytes no keyword has.
    """
    letters = sorted({c for word, _ in words for c in word})
    classes = np.zeros(256, np.int32)
    classes[letters] = np.arange(1, len(letters) + 1)
    children: list[dict[int, int]] = [{}]
    ranks = [NONE]
    for word, rank in words:
        state = 0
        for letter in classes[list(word)].tolist():
            if letter not in children[state]:
                children[state][letter] = len(children)
                children.append({})
                ranks.append(NONE)
            state = children[state][letter]
        ranks[state] = min(ranks[state], rank)
    following = np.zeros((len(children), len(letters) + 1), np.int32)
    best = np.array(ranks, np.int32)
    level = [(0, 0)]  # a state and the state of its longest proper end, nearest to the root first
    while level:
        below = []
        for state, end in level:
            best[state] = min(best[state], best[end])
            moves = following[end].copy()
            below += [(child, int(moves[letter]) if state else 0) for letter, child in children[state].items()]
            moves[list(children[state])] = list(children[state].values())
            following[state] = moves
        level = below
    return classes, following.ravel(), best


def _lanes(offsets: np.ndarray, lane: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the lanes, longest first; a lane starts ``lead`` bytes early so that no keyword is cut."""
    counts = np.maximum(1, -(-np.diff(offsets) // lane))
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + place * lane
    end = np.minimum(start + lane, offsets[row + 1])
    start = np.maximum(start - lead, offsets[row])
    order = np.argsort(start - end, kind="stable")
    return row[order], start[order], end[order]


def least_ranks(data: np.ndarray, offsets: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray], longest: int) -> np.ndarray:
    """Least rank of the keywords in each row of ``data``; ``offsets`` bound the rows."""
    classes, following, best = tables
    width = int(classes.max()) + 1
    row, start, end = _lanes(offsets, max(LANE, 4 * longest), longest - 1)
    state = np.zeros(len(row), np.int32)
    rank = np.full(len(row), best[0], np.int32)
    sizes = end - start
    for i in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes, -i, side="left"))  # lanes of more than i bytes
        state[:active] = following[state[:active] * width + classes[data[start[:active] + i]]]
        np.minimum(rank[:active], best[state[:active]], out=rank[:active])
    out = np.full(len(offsets) - 1, NONE, np.int32)
    np.minimum.at(out, row, rank)
    return out


def _row_blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1)
        yield first, end
        first = end


def classify_by_table(df: DataFrame, text: str, keywords: DataFrame, into: str = "categoria", default: str = DEFAULT_CATEGORY,
                      most_cells: int = MOST_CELLS) -> DataFrame:
    """Adds ``into``: the category of least ``orden`` of which a keyword stands anywhere in the lower-cased ``text``.

    ``keywords`` has ``orden int, categoria string, palabra string``. It is a table of rules and is read on the driver, which builds the
    automata. Of one ``orden`` the first category by code point counts, a null ``orden`` comes last. An empty keyword stands in every
    text; null texts and texts without a keyword get ``default``; keywords without a word or category do not count. The work grows with
    the bytes of the texts and, by whole automata of ``most_cells``, with the keyword table.
    """
    known = keywords.filter("palabra is not null and categoria is not null").select("orden", "categoria", "palabra").distinct()
    rows = [(r["orden"] is None, r["orden"] or 0, r["categoria"], r["palabra"].encode()) for r in known.toArrow().to_pylist()]
    ranked = sorted({r[:3] for r in rows})
    place = {key: i for i, key in enumerate(ranked)}
    least: dict[bytes, int] = {}
    for *key, word in rows:
        least[word] = min(least.get(word, NONE), place[tuple(key)])
    everywhere = least.pop(b"", NONE)
    parts = [(transitions(part), max(len(w) for w, _ in part)) for part in _parts(sorted(least.items()), most_cells)]
    names = pa.array([*[key[2] for key in ranked], default], pa.string())
    shared = df.sparkSession.sparkContext.broadcast((parts, names))

    @F.arrow_udf("string")
    def category(texts: pa.Array) -> pa.Array:
        parts, names = shared.value
        column = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        rank = np.full(len(column), everywhere, np.int64)
        for first, end in _row_blocks(offsets):
            for tables, longest in parts:
                found = least_ranks(data, offsets[first:end + 1], tables, longest)
                rank[first:end] = np.minimum(rank[first:end], found)
        rank[(rank == NONE) | texts.is_null().to_numpy(zero_copy_only=False)] = len(names) - 1
        return names.take(pa.array(rank))

    return df.withColumn(into, category(F.lower(F.col(text))))
