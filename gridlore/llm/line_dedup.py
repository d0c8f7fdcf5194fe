"""Fuzzy line deduplication: SimHash blocks find candidates, edit similarity verifies them, one line of a group stays."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlore.llm.common import broadcast_bits, partitions, released, table, text_of
from gridlore.llm.components import components
from gridlore.llm.forests import contract
from gridlore.llm.kernels import BLOCK_BYTES, LOWER, NON_ALNUM, byte_rows, mix, row_blocks, words
from gridlore.session import materialize

#: Lines of fewer words are compared exactly or not at all.
LEAST_WORDS = 5
#: Least edit similarity in percent of the longer line's words.
SIMILAR = 80
#: Blocks of four words taken of a line, about, where a few pairs of long lines may be missed; all are taken unless asked for.
BLOCKS = 10
#: Words of 64 bits of a line's map of its words, a power of two.
MAPS = 4
#: Lines of a key that one part meets all others with.
PART = 2_000
#: log2 of the bits of the filter for lines: 1 MB on every executor, whatever the data.
FILTER_BITS = 23
#: Block keys a task holds before it writes runs, and that one bucket holds about.
RUN, BUCKET_KEYS = 1 << 21, 1 << 21
#: Words of lines whose edit tables are worked out side by side, and of the pairs of lines that are told together.
TABLE_WORDS, PIECE_WORDS = 256, 1 << 19
#: Bits of a line's code that tell its hash, below those of its band of lengths.
CODE_BITS = 27
_BITS = [f"bits{k}" for k in range(MAPS)]
#: Lower case, and any digit as 0.
_FOLD = np.where((np.arange(256) >= 48) & (np.arange(256) <= 57), 48, LOWER).astype(np.uint8)


def _own_words(span: np.ndarray) -> np.ndarray:
    """Starts and ends of characters of scripts that put no space between words; each counts as a word.

    Kana, Chinese characters, Thai, Lao, Khmer and Myanmar.
    """
    if not (span >= 0xE0).any():
        return np.zeros(0, np.int64)
    second = np.append(span[1:], 0)
    three = ((span >= 0xE3) & (span <= 0xE9) | (span == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
             | (span == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F)))
    three, four = np.flatnonzero(three), np.flatnonzero((span == 0xF0) & (second >= 0xA0))
    return np.minimum(np.concatenate([three, three + 3, four, four + 4]), len(span))


def _lines(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For blocks of rows: first row, end row, the words of all their lines, and per line its row, number and word range."""
    data, offsets = byte_rows(column)
    for first, end in row_blocks(offsets, BLOCK_BYTES):
        span = data[offsets[first]:offsets[end]]
        at = offsets[first:end + 1] - offsets[first]
        # a line starts with its row and after every line break
        breaks = np.flatnonzero(span == 0x0A) + 1
        row_of_break = np.searchsorted(at, breaks - 1, side="right") - 1
        rows = np.concatenate([np.arange(end - first), row_of_break])
        starts = np.concatenate([at[:-1], breaks])
        order = np.lexsort((starts, rows))
        rows, starts = rows[order], starts[order]
        numbers = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        cuts = np.unique(np.concatenate([starts, [len(span)], _own_words(span)]))
        hashes, where = words(_FOLD[span], cuts, NON_ALNUM)
        begin = where[np.searchsorted(cuts, starts)]
        # an empty last line starts where the next row does and has no words
        stop = where[np.searchsorted(cuts, np.append(starts[1:], len(span)))]
        yield first, end, hashes, np.stack([rows, numbers, begin, np.maximum(stop, begin)], axis=1)


def _runs(hashes: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the given lines one after the other, where each line starts there, and its number of words (one at least)."""
    sizes = lines[:, 3] - lines[:, 2]
    starts = np.cumsum(sizes) - sizes
    return hashes[np.arange(int(sizes.sum())) + np.repeat(lines[:, 2] - starts, sizes)], starts, sizes


def _line_hashes(own: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits over the words of each line in their order."""
    if not len(starts):
        return np.zeros(0, np.int64)
    power = mix((np.arange(1, len(own) + 1) - np.repeat(starts, sizes)).astype(np.uint64))
    return mix(np.add.reduceat(own * (power | np.uint64(1)), starts)).view(np.int64)


def _codes(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """32 bits for each line: its band of lengths, then bits of its hash. Two lines within the edits have the same band or the next."""
    band = np.floor(np.log(np.maximum(sizes, LEAST_WORDS)) / math.log(1.25) + 1e-9) - math.floor(math.log(LEAST_WORDS) / math.log(1.25))
    code = np.minimum(band, 31).astype(np.uint64) << np.uint64(CODE_BITS) | hashes.view(np.uint64) >> np.uint64(64 - CODE_BITS)
    return code.astype(np.uint32)


def _word_bits(own: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each line ``64 * MAPS`` bits that tell where an odd number of its words falls; an edit changes two at most."""
    if not len(starts):
        return [np.zeros(0, np.int64)] * MAPS
    bit = np.uint64(1) << (own >> np.uint64(58))
    part = own & np.uint64(MAPS - 1)
    return [np.bitwise_xor.reduceat(np.where(part == k, bit, np.uint64(0)), starts).view(np.int64) for k in range(MAPS)]


def _three_of_four(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return a & b & (c | d) | c & d & (a | b)


def block_keys(own: np.ndarray, starts: np.ndarray, sizes: np.ndarray, blocks: int | None = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Line and key of the SimHash blocks of lines of five words or more.

    A block is a run of words, its key the SimHash of the run: the bits that most of its words have. ``e`` edits leave ``e + 1``
    stretches of the longer line, and by the pigeonhole principle one of them has as many words as a block: at 80 percent
    three words in lines of 6 to 16 words, four in longer ones. Five words may be left with two on either side of
    the one in the middle, so these have a block without it. Lines of 13 to 16 words have both kinds, since they may be near lines of
    either side. So two lines within the edits agree in a block; of runs of four only about ``blocks`` a line are taken, those
    of the smallest keys for its length, unless it is None.
    """
    line, size = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes, sizes)
    left = size - np.arange(len(own)) + np.repeat(starts, sizes)  # words from here to the end of the line
    at = np.flatnonzero((size >= 5) & (size <= 16) & (left >= 3))
    a, b, c = own[at], own[at + 1], own[at + 2]
    lines, keys = [line[at]], [mix((a & b | b & c | a & c) ^ np.uint64(3))]
    at = np.flatnonzero((size == 5) & (left == 5))
    lines.append(line[at])
    keys.append(mix(_three_of_four(own[at], own[at + 1], own[at + 3], own[at + 4]) ^ np.uint64(5)))
    at = np.flatnonzero((size >= 13) & (left >= 4))
    key = mix(_three_of_four(own[at], own[at + 1], own[at + 2], own[at + 3]) ^ np.uint64(4))
    if blocks:  # what a longer line takes a shorter one takes too
        few = (key >> np.uint64(11)).astype(np.float64) * (size[at] - 3) < blocks * 2.0 ** 53
        at, key = at[few], key[few]
    lines.append(line[at])
    keys.append(key)
    return np.concatenate(lines), np.concatenate(keys).view(np.int64)


def spares(own: np.ndarray, starts: np.ndarray, sizes: np.ndarray, blocks: int | None = None) -> np.ndarray:
    """How many of its block keys a line may leave out and still have one in common with every line within the edits; none if few are taken.

    A change or a loss of a word takes three runs of three words, a new word between two takes two of them, and at 80 percent
    the edits that lead to a line of any length take ``0.6 n`` runs of three at most, and ``0.8 n`` of four. The other
    different keys are in both lines; if each line leaves out its first ones in one order of all keys, the last of those in
    common stays. Lines of 13 to 16 words, which have keys of both kinds, leave out none.
    """
    line, keys = block_keys(own, starts, sizes, blocks)
    # with the half of a key that a run holds whole
    line = (_distinct(line.astype(np.uint64) << np.uint64(32) | keys.view(np.uint64) & np.uint64(0xFFFFFFFF)) >> np.uint64(32)).astype(np.int64)
    lost = np.where(sizes >= 17, 4 * sizes // 5, np.where((sizes >= 6) & (sizes <= 12), 3 * sizes // 5, np.int64(1) << 40))
    return np.maximum(np.bincount(line, minlength=len(sizes)) - lost - 1, 0).astype(np.int32)


def _line_rows(docs: DataFrame, least_words: int, short_copies: bool, blocks: int | None) -> DataFrame:
    """``doc_id, text_key, line, h, n, code, spare, bits0..`` per line of enough words, and a row with the number of lines as ``line`` and null ``h`` per document.

    With ``short_copies`` lines of fewer words have a row too, with null ``n``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, hashes, lines in _lines(batch.column(2)):
                long = lines[lines[:, 3] - lines[:, 2] >= (1 if short_copies else max(1, least_words))]
                runs = _runs(hashes, long)
                few = runs[2] < least_words
                counts = np.bincount(lines[:, 0], minlength=end - first)
                index = pa.array(np.concatenate([np.arange(end - first), long[:, 0]]) + first)
                each = _line_hashes(*runs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index), pa.array(np.concatenate([counts, long[:, 1]])),
                     pa.concat_arrays([pa.nulls(end - first, pa.int64()), pa.array(each)]),
                     pa.concat_arrays([pa.nulls(end - first, pa.int32()), pa.array(runs[2].astype(np.int32), mask=few)]),
                     pa.concat_arrays([pa.nulls(end - first, pa.int32()), pa.array(_codes(each, runs[2]).view(np.int32), mask=few)]),
                     pa.concat_arrays([pa.nulls(end - first, pa.int32()), pa.array(spares(*runs, blocks), mask=few)]),
                     *[pa.concat_arrays([pa.nulls(end - first, pa.int64()), pa.array(bits)]) for bits in _word_bits(runs[0], runs[1])]],
                    names=["doc_id", "text_key", "line", "h", "n", "code", "spare", *_BITS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(released(run), f"doc_id {kind}, text_key long, line long, h long, n int, code int, spare int, {', '.join(f'{b} long' for b in _BITS)}")


def _line_words(docs: DataFrame, asked, least_words: int) -> DataFrame:
    """``h, words`` of the lines whose bit is set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = asked.value
        for batch in batches:
            for _, _, hashes, lines in _lines(batch.column(2)):
                lines = lines[lines[:, 3] - lines[:, 2] >= max(1, least_words)]
                each = _line_hashes(*_runs(hashes, lines))
                found = {int(each[i]): hashes[lines[i, 2]:lines[i, 3]].tobytes() for i in np.flatnonzero(_marked(bits, each, FILTER_BITS))}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["h", "words"])

    return docs.mapInArrow(released(run), "h long, words binary")


def _marked(bits: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Whether the bit of each value's upper ``size`` bits is set."""
    at = values.view(np.uint64) >> np.uint64(64 - size)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; ``np.unique`` of many whole numbers takes a hash table and fifty times as long."""
    values = np.sort(values)
    return values[np.append(np.ones(min(1, len(values)), bool), values[1:] != values[:-1])]


def packed(values: np.ndarray) -> bytes:
    """Sorted pairs of 32 bits: differences of the upper halves and the lower halves, as byte planes compressed by zstd."""
    upper = np.diff((values >> np.uint64(32)).astype(np.uint32), prepend=np.uint32(0))
    planes = np.stack([upper, values.astype(np.uint32)]).astype("<u4").view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(run: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), dtype=np.uint8).reshape(2, 4, -1)
    upper, lower = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]
    return np.cumsum(upper, dtype=np.uint32).astype(np.uint64) << np.uint64(32) | lower


def _runs_of(keys: np.ndarray, codes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``bucket, run``: the lower halves of the keys with the codes of their lines, by buckets of the upper halves."""
    keys = keys.view(np.uint64)
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")
    values = (keys << np.uint64(32) | codes)[order]
    found, starts = np.unique(bucket[order], return_index=True)
    runs = [packed(_distinct(x)) for x in np.split(values, starts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(runs, pa.binary())], names=["bucket", "run"])


def _spilled(docs: DataFrame, least_words: int, blocks: int | None, buckets: int) -> DataFrame:
    """``bucket, run``: block keys of all lines of enough words with the lines' codes, in sorted runs of about six bytes a key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], 0
        for batch in batches:
            for _, _, hashes, lines in _lines(batch.column(0)):
                lines = lines[lines[:, 3] - lines[:, 2] >= max(1, least_words)]
                each, where = np.unique(_line_hashes(*_runs(hashes, lines)), return_index=True)
                own = _runs(hashes, lines[where])
                at, keys = block_keys(*own, blocks)
                held.append((keys, _codes(each, own[2])[at]))
                room += len(keys)
                if room >= RUN:
                    yield _runs_of(*map(np.concatenate, zip(*held)), buckets)
                    held, room = [], 0
        if room:
            yield _runs_of(*map(np.concatenate, zip(*held)), buckets)

    return docs.select("text").mapInArrow(released(run), "bucket int, run binary")


def meetings(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of codes to compare first, and the rows that these pairs do not settle, both as 64 bits, with the rows that their keys have.

    ``values`` are distinct and sorted: a key, then a code. Of every key and band one line, by an order of the key's own, meets the others
    and those of the band below. So lines of a group meet many others of it. The other pairs of lines of a key in the same
    or neighbouring bands are pairs of rows returned.
    """
    group = values >> np.uint64(CODE_BITS)  # key and band
    beside = (group[1:] >> np.uint64(5) == group[:-1] >> np.uint64(5)) & (group[1:] - group[:-1] <= np.uint64(1))
    alone = ~np.append(beside, False) & ~np.append(np.zeros(min(1, len(values)), bool), beside)
    values, group = values[~alone], group[~alone]
    if not len(values):
        return values, values, values.astype(np.int64)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(values)))
    own = np.repeat(np.arange(len(starts)), sizes)
    above = np.append((group[starts[1:]] == group[starts[:-1]] + np.uint64(1)) & (group[starts[:-1]] & np.uint64(31) != np.uint64(31)), False)
    below = np.append(False, above[:-1])
    order = mix(values)
    first = order == np.minimum.reduceat(order, starts)[own]
    code, tops = values & np.uint64(0xFFFFFFFF), values[first] & np.uint64(0xFFFFFFFF)
    u = np.concatenate([code[~first], code[above[own]]])
    v = np.concatenate([tops[own[~first]], tops[own[above[own]] + 1]])
    pairs = _distinct(np.minimum(u, v) << np.uint64(32) | np.maximum(u, v))
    open_above = above & (np.append(sizes[1:], 0) > 1)
    rest = open_above[own] | ~first & ((sizes > 2) | below)[own]
    keys = np.flatnonzero(np.append(True, values[1:] >> np.uint64(32) != values[:-1] >> np.uint64(32)))
    rows = np.diff(np.append(keys, len(values)))
    return pairs, values[rest], np.repeat(rows, rows)[rest]


def _met(spilled: DataFrame, buckets: int) -> DataFrame:
    """``key, u, v``: with null ``key`` the codes of two lines to compare, else the code ``u`` of one of the ``v`` lines of the key; see ``meetings``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(bucket, []).append(unpacked(x.as_buffer()))
        for bucket in list(held):
            pairs, rest, sizes = meetings(_distinct(np.concatenate(held.pop(bucket))))
            for key, rows in ((None, pairs), (np.int64(bucket) << np.int64(32), rest)):  # keys of 32 bits and those of the bucket
                for i in range(0, len(rows), 1 << 17):
                    upper, lower = (rows[i:i + (1 << 17)] >> np.uint64(32)).astype(np.uint32), rows[i:i + (1 << 17)].astype(np.uint32)
                    columns = [pa.nulls(len(upper), pa.int64()), pa.array(upper.view(np.int32)), pa.array(lower.view(np.int32))] if key is None else [
                        pa.array(upper.astype(np.int64) | key), pa.array(lower.view(np.int32)), pa.array(sizes[i:i + (1 << 17)].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "u", "v"])

    return spilled.repartitionById(buckets, "bucket").mapInArrow(released(run), "key long, u int, v int")


def within_edits(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether at most ``most`` insertions, deletions and changes of words lead from ``x`` to ``y``."""
    if abs(len(x) - len(y)) > most:
        return False
    short = min(len(x), len(y))
    same = x[:short] == y[:short]
    head = short if same.all() else int(np.argmin(same))
    x, y = x[head:], y[head:]
    short = min(len(x), len(y))
    same = x[::-1][:short] == y[::-1][:short]
    tail = short if same.all() else int(np.argmin(same))
    x, y = x[:len(x) - tail], y[:len(y) - tail]
    if not len(x) or not len(y):
        return max(len(x), len(y)) <= most
    # so many changes lead there at most
    if max(len(x), len(y)) <= most or len(x) == len(y) and int((x != y).sum()) <= most:
        return True
    # words that only one side has cost an edit each
    found, which = np.unique(np.concatenate([x, y]), return_inverse=True)
    more = np.bincount(which[:len(x)], minlength=len(found)) - np.bincount(which[len(x):], minlength=len(found))
    if max(int(more[more > 0].sum()), -int(more[more < 0].sum())) > most:
        return False
    # columns of the edit table as bits: where a value rises or falls by one from row to row (Myers 1999)
    places: dict[int, int] = {}
    for i, word in enumerate(x.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    every = (1 << len(x)) - 1
    last = 1 << (len(x) - 1)
    rises, falls, edits = every, 0, len(x)
    for left, word in zip(range(len(y) - 1, -1, -1), y.tolist()):
        equal = places.get(word, 0)
        level = equal | falls
        across = (((equal & rises) + rises) ^ rises) | equal
        up, down = falls | ~(across | rises) & every, rises & across
        edits += bool(up & last) - bool(down & last)
        if edits - left > most:
            return False
        up, down = (up << 1 | 1) & every, (down << 1) & every
        rises, falls = down | ~(level | up) & every, up & level
    return edits <= most


def _table_edits(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, most: int) -> np.ndarray:
    """Word edits between the rows of ``x`` and ``y``, right where they are at most ``most``: all tables at once, ``most`` to either side of
    their diagonals. Rows are padded beyond their sizes, which differ by ``most`` at most."""
    width, far = 2 * most + 1, np.int32(1 << 20)
    off = np.arange(-most, most + 1, dtype=np.int32)
    padded = np.zeros((len(y), x.shape[1] + width), np.uint64)
    padded[:, most:most + y.shape[1]] = y[:, :padded.shape[1] - most]
    row = np.where(off >= 0, off, far)[None].repeat(len(x), 0)
    found = np.where(nx == 0, ny, far).astype(np.int32)
    for i in range(1, x.shape[1] + 1):
        step = row + (padded[:, i - 1:i - 1 + width] != x[:, i - 1:i])
        np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
        if i <= most:  # before the first word of y
            step[:, :most - i] = far
            step[:, most - i] = i
        row = np.minimum.accumulate(step - off, axis=1) + off
        ends = np.flatnonzero(nx == i)
        found[ends] = row[ends, (ny - nx)[ends] + most]
    return found


def _as_rows(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of words as rows of a matrix, zeros behind them."""
    at = np.arange(max(1, int(sizes.max())))[None]
    return np.where(at < sizes[:, None], words[np.minimum(starts[:, None] + at, max(0, len(words) - 1))] if len(words) else np.uint64(0), np.uint64(0))


def all_within_edits(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, similar: int) -> np.ndarray:
    """For pairs of lines, their words one after the other with the lines' sizes, whether edits are at most ``100 - similar`` percent of the longer line.

    Changes in place and words that only one side has decide most pairs; the tables of lines of up to ``TABLE_WORDS`` words are
    worked out side by side.
    """
    most = (100 - similar) * np.maximum(nx, ny) // 100
    x_at, y_at = np.cumsum(nx) - nx, np.cumsum(ny) - ny
    near = np.zeros(len(nx), bool)
    pair_x, pair_y = np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)
    even = nx == ny
    changed = x[even[pair_x]] != y[even[pair_y]]
    near[even] = np.bincount(pair_x[even[pair_x]][changed], minlength=len(nx))[even] <= most[even]
    # 14 bits of the pair, 49 of the word, the side: words taken for one another only make sides look more alike
    undecided = np.flatnonzero(~near & (np.abs(nx - ny) <= most))
    for first in range(0, len(undecided), 1 << 14):
        some = undecided[first:first + (1 << 14)]
        number = np.full(len(nx), -1)
        number[some] = np.arange(len(some))
        marks = [number[p].astype(np.uint64)[number[p] >= 0] << np.uint64(50) | w[number[p] >= 0] >> np.uint64(15) << np.uint64(1) | np.uint64(side)
                 for side, (w, p) in enumerate(((x, pair_x), (y, pair_y)))]
        marks = np.sort(np.concatenate(marks))
        if not len(marks):
            continue
        word = marks >> np.uint64(1)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        more = np.add.reduceat(1 - 2 * (marks & np.uint64(1)).astype(np.int64), starts)
        of = (marks[starts] >> np.uint64(50)).astype(np.int64)
        left, right = (np.bincount(of, np.maximum(more * sign, 0), len(some)) for sign in (1, -1))
        undecided[first:first + (1 << 14)] = np.where(np.maximum(left, right) <= most[some], some, -1)
    undecided = undecided[undecided >= 0]
    undecided = undecided[np.argsort(np.maximum(nx, ny)[undecided], kind="stable")]
    while len(undecided):
        size = int(max(nx[undecided[0]], ny[undecided[0]]))
        if size > TABLE_WORDS:
            for i in undecided.tolist():
                near[i] = within_edits(x[x_at[i]:x_at[i] + nx[i]], y[y_at[i]:y_at[i] + ny[i]], int(most[i]))
            break
        some = undecided[:512]
        some = some[np.maximum(nx, ny)[some] <= min(TABLE_WORDS, size + max(4, size // 8))]
        edits = _table_edits(_as_rows(x, x_at[some], nx[some]), nx[some], _as_rows(y, y_at[some], ny[some]), ny[some], int(most[some].max()))
        near[some] = edits <= most[some]
        undecided = undecided[len(some):]
    return near


def _verified(pairs: DataFrame, texts: DataFrame, similar: int) -> DataFrame:
    def words_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.uint64), np.diff(offsets) // 8

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, nx = words_in(batch.column(2))
            y, ny = words_in(batch.column(3))
            x_at, y_at = (np.append(0, np.cumsum(n)) for n in (nx, ny))
            first = 0
            while first < len(nx):  # pieces of a bounded number of words, whatever the lines' lengths
                end = max(first + 1, int(np.searchsorted(x_at + y_at, x_at[first] + y_at[first] + PIECE_WORDS, side="right")) - 1)
                links = all_within_edits(x[x_at[first]:x_at[end]], nx[first:end], y[y_at[first]:y_at[end]], ny[first:end], similar)
                some = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1)], names=["u", "v"]).filter(pa.array(links, pa.bool_()))
                first = end

    left = pairs.join(texts.select(F.col("h").alias("u"), F.col("words").alias("x")), "u")
    both = left.join(texts.select(F.col("h").alias("v"), F.col("words").alias("y")), "v").select("u", "v", "x", "y")
    # few bytes may be many comparisons: by size alone they would end up in few tasks, and a line of many pairs in one
    return both.repartition(partitions(pairs.sparkSession), "u", "v").mapInArrow(released(run), "u long, v long")


def _near(a: str, b: str, similar: int) -> Column:
    """Whether sizes and word bits of two lines allow so few edits."""
    x, y = F.col(a), F.col(b)
    edits = F.floor((100 - similar) * F.greatest(x["n"], y["n"]) / 100)
    return (F.abs(x["n"] - y["n"]) <= edits) & (sum(F.bit_count(x[b].bitwiseXOR(y[b])) for b in _BITS) <= 2 * edits)


def _unsettled_pairs(placed: DataFrame, sims: DataFrame, similar: int) -> DataFrame:
    """``u, v`` of lines of different components that meet in a key, all that may be within the edits.

    Lines meet only those of their own band of lengths or the next, and the lines of a key are dealt over parts of about
    ``PART`` that each meet all, so no task gets a whole hot key.
    """
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
    split = split.filter("x <> y").select("key", F.ceil(F.col("m") / PART).cast("int").alias("parts"))
    band = F.floor(F.log(F.col("sim.n")) / math.log(100 / similar) + 1e-9)  # a little up: a border must not part lines within the edits
    unsettled = materialize(placed.join(split, "key").join(sims, "h").withColumn("band", band), "unsettled")
    shorter = unsettled.withColumn("part", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int"))
    longer = unsettled.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn(
        "band", F.explode(F.array("band", F.col("band") - 1)))
    ordered = F.struct(F.col("a.sim.n"), F.col("a.h")) < F.struct(F.col("b.sim.n"), F.col("b.h"))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "band", "part")]
    pairs = shorter.alias("a").join(longer.alias("b"), [*same, ordered, F.col("a.component") != F.col("b.component"), _near("a.sim", "b.sim", similar)])
    return pairs.select(F.least("a.h", "b.h").alias("u"), F.greatest("a.h", "b.h").alias("v")).distinct()


def line_groups(docs: DataFrame, least_words: int = LEAST_WORDS, similar: int = SIMILAR, blocks: int | None = None,
                short_copies: bool = False) -> DataFrame:
    """``doc_id, text_key, n_lines, n_removed, removed``, one row per distinct pair of id and text of ``docs``.

    Lines count from 0 and are compared as lower-case words without punctuation, every digit as 0; in scripts without
    spaces a character is a word. Lines of fewer than ``least_words`` words stay, but with ``short_copies`` they go where they are equal
    to another; lines without words always stay. Two lines are near when they agree in a SimHash block (see ``block_keys``) and word edits
    are at most ``100 - similar`` percent of the longer line; without a number of ``blocks`` the edits alone decide and no pair is
    missed. ``similar`` is 80 at least. Of every connected group the occurrence of the smallest id, then line,
    stays; ``removed`` lists the other lines of a document. A null id comes last; a null or empty text is one line without words.
    """
    if not 80 <= similar < 100:
        raise ValueError("blocks of three and four words need a similarity of 80 to 99 percent")
    docs = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), "text")
    rows = materialize(_line_rows(docs, least_words, short_copies, blocks), "lines")
    sims = materialize(rows.filter("n is not null").groupBy("code", "h").agg(
        F.first(F.struct("n", *_BITS)).alias("sim"), F.first("spare").alias("spare")), "line-sims")
    # a line has about as many keys as words; they are shuffled as compressed runs, and only rows of keys that lines share come back
    n_words = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), math.ceil(n_words / BUCKET_KEYS))
    met = materialize(_met(_spilled(docs, least_words, blocks, buckets), buckets), "met")
    # lines of one code are compared without more ado
    twins = sims.groupBy("code").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x <> y").select(F.col("code").alias("u"), F.col("code").alias("v"))
    first = met.filter("key is null").select("u", "v").unionByName(twins).distinct()
    for code, h, sim in (("u", "a", "x"), ("v", "b", "y")):
        first = first.join(sims.select(F.col("code").alias(code), F.col("h").alias(h), F.col("sim").alias(sim)), code)
    first = first.filter((F.col("a") != F.col("b")) & _near("x", "y", similar))
    first = materialize(first.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "pairs")

    def texts(pairs: DataFrame) -> DataFrame:
        asked = materialize(pairs.select(F.col("u").alias("h")).unionByName(pairs.select(F.col("v").alias("h"))).distinct(), "asked")
        bits = broadcast_bits(asked.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("at")), "at", FILTER_BITS)
        # a line that stands in many documents is one row of each task before it is shuffled
        found = _line_words(docs, bits, least_words).groupBy("h").agg(F.first("words").alias("words"))
        return materialize(found.join(asked, "h", "left_semi"), "line-words")

    edges = materialize(_verified(first, texts(first), similar), "links")
    found = components(edges, contract)
    # what a line may leave out are the keys of most lines
    left_out = sims.groupBy(F.col("code").alias("u")).agg(F.min("spare").alias("spare")).filter("spare > 0")
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.col("v").desc(), "key"))
    kept = met.filter("key is not null").withColumn("place", place).join(left_out, "u", "left").filter("place > coalesce(spare, 0)")
    named = sims.select("code", "h").join(found.withColumnRenamed("node", "h"), "h", "left").select(
        F.col("code").alias("u"), "h", F.coalesce("component", "h").alias("component"))
    placed = materialize(kept.select("key", "u").join(named, "u").select("key", "h", "component"), "placed")
    second = _unsettled_pairs(placed, sims.select("h", "sim"), similar).join(first, ["u", "v"], "left_anti")
    second = materialize(second, "pairs")
    more = second if second.isEmpty() else materialize(_verified(second, texts(second), similar), "links")
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), contract)

    placed = materialize(rows.filter("h is not null").join(found.withColumnRenamed("node", "h"), "h", "left").select(
        "doc_id", "text_key", "line", F.coalesce("component", "h").alias("component")), "placed")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"), F.col("line"))
    kept = materialize(placed.groupBy("component").agg(F.min(place).alias("kept")), "kept")
    removed = placed.join(kept, "component").filter(place != F.col("kept")).select("doc_id", "text_key", "line", F.lit(None).cast("long").alias("n_lines"))
    counts = rows.filter("h is null").select("doc_id", "text_key", F.lit(None).cast("long").alias("line"), F.col("line").alias("n_lines"))
    whole = removed.distinct().unionByName(counts).groupBy("doc_id", "text_key").agg(
        F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_list("line")).alias("removed"))
    return whole.select("doc_id", "text_key", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def drop_fuzzy_lines(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with the removed lines cut out of ``text``; a text without removed lines stays as it is."""
    groups = materialize(line_groups(docs, **settings).filter("n_removed > 0"), "line-groups")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("g.text_key"))
    stay = F.filter(F.split("d.text", "\n"), lambda _, i: ~F.array_contains(F.col("g.removed"), i.cast("long")))
    text = F.when(F.col("g.removed").isNull(), F.col("d.text")).otherwise(F.array_join(stay, "\n"))
    return docs.alias("d").join(groups.alias("g"), same, "left").select(
        *[text.alias("text") if c == "text" else F.col(f"d.{c}") for c in docs.columns])


def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_groups(table(spark, sf_dir, "documents"), short_copies=True).select("doc_id", "n_lines", "n_removed", "removed")
