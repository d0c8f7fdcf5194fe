"""Alignment of two tokenizers: token pairs that share bytes, counted over the corpus from spilled, merged runs."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import table
from gridlore.llm.kernels import WHITE, byte_rows
from gridlore.llm.token_files import text_blocks
from gridlore.session import materialize, spread

#: Radix buckets of the pairs, all pairs of a B id in one; fixed, so that a document's contributions do not grow with the data.
BUCKETS = 64
#: Records a task holds before it writes runs, records of a compressed block of a run, and bytes of runs merged by one task.
RUN, CHUNK, PART_BYTES = 2_000_000, 16_384, 16 << 20
BLOCK_BYTES, CACHED_WORDS = 2 << 20, 150_000


class Lexicon:
    """What both tokenizers make of every distinct word a task has met: counts, links and the text of its groups."""

    def __init__(self, byte_path: str | None, piece_path: str | None):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(byte_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = {rank: token for token, rank in ranks.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path or public_tokenizers.path("piece_bpe_32k.model"))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.counts: list[tuple[int, int, int, int, bool]] = []
        self.links: list[bytes] = []
        self.groups: list[bytes] = []

    def places(self, words: list[bytes]) -> np.ndarray:
        """Where each word stands in the lists; new words are added."""
        new = [w for w in words if w not in self.place]
        for word, b in zip(new, self.b.encode([w[1:].decode("utf-8", "replace") for w in new], num_threads=1) if new else ()):
            a = self.a.encode_ordinary(word.decode("utf-8", "replace"))
            a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
            good = b"".join(a_parts) == word == b"".join(b_parts)
            links, groups = align(a, a_parts, b, b_parts) if good else ([], [])
            self.place[word] = len(self.counts)
            self.counts.append((len(a), len(b), len(groups), len(links), good))
            self.links.append(np.array(links, dtype="<u4").tobytes())
            self.groups.append(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups).encode())
        return np.fromiter((self.place[w] for w in words), np.int64, len(words))


def align(a: list[int], a_parts: list[bytes], b: list[int], b_parts: list[bytes]) -> tuple[list[int], list[tuple[list[int], list[int]]]]:
    """Links (B id times 2**16 plus A id, for every pair of tokens that share a byte) and the groups that both sides' ends cut."""
    links, groups, i, j, a_from, b_from = [], [], 0, 0, 0, 0
    a_end, b_end = len(a_parts[0]) if a else 0, len(b_parts[0]) if b else 0
    while i < len(a) and j < len(b):
        links.append(b[j] << 16 | a[i])
        a_step, b_step = a_end <= b_end, b_end <= a_end
        i, j = i + a_step, j + b_step
        if a_step and b_step:
            groups.append((a[a_from:i], b[b_from:j]))
            a_from, b_from = i, j
        if a_step and i < len(a):
            a_end += len(a_parts[i])
        if b_step and j < len(b):
            b_end += len(b_parts[j])
    return links, groups


@lru_cache(maxsize=1)
def _lexicon(byte_path: str | None, piece_path: str | None) -> Lexicon:
    return Lexicon(byte_path, piece_path)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of rows, and of the spaces between two bytes that are no white space: there both tokenizers end a token.

    A's pattern joins no white space to what stands before it and B has no piece with a space after another character.
    After a byte that may end a white-space character of several bytes there is no cut.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 4:
        before, second, third = data[2:-2], data[1:-3], data[:-4]
        wide = (before >= 0x80) & (((second == 0xC2) & ((before == 0x85) | (before == 0xA0))) | ((third >= 0xE1) & (third <= 0xE3)))
        cut[3:-2] = (data[3:-1] == 0x20) & ~WHITE[before] & ~WHITE[data[4:]] & ~wide
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


class Runs:
    """Records of pair, document and number of links, written as compressed runs once a task holds many."""

    def __init__(self, chunk: int = CHUNK):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.chunk = 0, chunk

    def add(self, keys: np.ndarray, links: np.ndarray) -> None:
        self.parts.append((keys, links))
        self.held += len(keys)

    def flush(self) -> Iterator[tuple[int, int, list[int], list[bytes]]]:
        """Bucket, compressed bytes, first keys and blocks of every run; a run is sorted by B id, A id, document."""
        if not self.held:
            return
        keys, links = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.held = [], 0
        keys, links = combined(keys, links)
        bucket = bucket_of(keys >> np.uint64(48))
        order = np.argsort(bucket.astype(np.uint8 if BUCKETS <= 256 else np.uint16), kind="stable")
        at = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        for b in range(BUCKETS):
            mine = order[at[b]:at[b + 1]]
            if len(mine):
                k, n = keys[mine], links[mine]
                blocks = [pack(k[i:i + self.chunk], n[i:i + self.chunk]) for i in range(0, len(k), self.chunk)]
                yield b, sum(map(len, blocks)), k[::self.chunk].astype(np.int64).tolist(), blocks


def bucket_of(b: np.ndarray) -> np.ndarray:
    return (b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(BUCKETS)


def combined(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their numbers."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(numbers[order], first)


def pack(keys: np.ndarray, links: np.ndarray) -> bytes:
    """A block: differences of the keys' halves and the numbers, byte planes compressed by zstd."""
    columns = [np.diff(x, prepend=np.uint32(0)).astype("<u4") for x in ((keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32))]
    planes = np.stack([*columns, links.astype("<u4")]).view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), dtype=np.uint8)
    high, low, links = np.ascontiguousarray(planes.reshape(3, 4, -1).transpose(0, 2, 1)).view("<u4")[:, :, 0]
    high, low = (np.cumsum(x, dtype=np.uint32).astype(np.uint64) for x in (high, low))
    return high << np.uint64(32) | low, links.astype(np.int64)


def merge(runs: list[tuple[int, list[int], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, numbers and origins of all runs in key order, in pieces; a run is its origin, first keys and blocks.

    A heap holds the first key of every run's next block. What lies below the heap's least key is complete; no more is
    held than that and the blocks that overlap it.
    """
    heap = [(firsts[0], r, 0) for r, (_, firsts, _) in enumerate(runs)]
    heapq.heapify(heap)
    held, size, enough = [], 0, 4 * CHUNK
    while heap:
        _, r, i = heapq.heappop(heap)
        origin, firsts, blocks = runs[r]
        keys, numbers = unpack(blocks[i])
        held.append((keys, numbers, np.full(len(keys), origin, dtype=np.int64)))
        size += len(keys)
        if i + 1 < len(blocks):
            heapq.heappush(heap, (firsts[i + 1], r, i + 1))
        if size >= enough or not heap:
            keys, numbers, origins = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            done = int(np.searchsorted(keys[order], np.uint64(heap[0][0]))) if heap else len(keys)
            if done:
                yield keys[order[:done]], numbers[order[:done]], origins[order[:done]]
            rest = order[done:]
            held, size = [(keys[rest], numbers[rest], origins[rest])], len(rest)
            enough = 4 * CHUNK + 2 * size


_SPILL = ("origin int, doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "bucket int, run int, bytes long, firsts array<long>, blocks array<binary>")


def spill(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, held: int = RUN, chunk: int = CHUNK,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A written table of a row for each document (``origin, doc`` name it) and a row for each run of its task's records."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, runs, origin, doc, number = _lexicon(byte_path, piece_path), Runs(chunk), TaskContext.get().partitionId(), 0, 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for start, end in text_blocks(batch.column(1), block_bytes):
                counts, digests, records = describe(batch.column(1)[start:end], lexicon, doc)
                runs.add(*records)
                yield _rows(id_type, end - start, {
                    "doc_id": batch.column(0)[start:end], "origin": np.full(end - start, origin, np.int32),
                    "doc": np.arange(doc, doc + end - start, dtype=np.int32), "groups_sha256": digests,
                    **{name: counts[:, i] for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}})
                doc += end - start
                if runs.held >= held:
                    for made in runs.flush():
                        yield _run_row(id_type, origin, number, made)
                        number += 1
        for made in runs.flush():
            yield _run_row(id_type, origin, number, made)
            number += 1

    return materialize(spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, {_SPILL}"), "align")


_TYPES = {"origin": pa.int32(), "doc": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "bucket": pa.int32(), "run": pa.int32(), "bytes": pa.int64(),
          "firsts": pa.list_(pa.int64()), "blocks": pa.list_(pa.binary())}


def _rows(id_type: pa.DataType, n: int, given: dict) -> pa.RecordBatch:
    """A batch of ``n`` rows, null in the columns not given."""
    columns = {name: pa.array(given[name], type=kind) if name in given else pa.nulls(n, kind) for name, kind in {"doc_id": id_type, **_TYPES}.items()}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _run_row(id_type: pa.DataType, origin: int, number: int, made: tuple[int, int, list[int], list[bytes]]) -> pa.RecordBatch:
    bucket, size, firsts, blocks = made
    return _rows(id_type, 1, {"origin": [origin], "run": [number], "bucket": [bucket], "bytes": [size], "firsts": [firsts], "blocks": [blocks]})


def describe(texts: pa.Array, lexicon: Lexicon, first_doc: int) -> tuple[np.ndarray, list[str], tuple[np.ndarray, np.ndarray]]:
    """``n_a, n_b, n_groups, n_links`` and the digest of the groups of every text, and the records of pair and document."""
    texts = texts.fill_null("").cast(pa.large_string())
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    data, offsets = byte_rows(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    starts = cuts(data, offsets)
    bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))])
    coded = words.dictionary_encode()
    if len(lexicon.place) > CACHED_WORDS:
        lexicon.clear()
    places = lexicon.places(coded.dictionary.to_pylist())
    codes = coded.indices.to_numpy()
    own = np.array([lexicon.counts[i] for i in places], dtype=np.int64).reshape(-1, 5)
    rows = np.searchsorted(starts, offsets)
    sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(own[codes], axis=0)])[rows]
    sums = np.diff(sums, axis=0)
    good = ~empty & (sums[:, 4] == np.diff(rows))
    counts = np.where(good[:, None], sums[:, :4], 0)
    texts_of = [lexicon.groups[i] for i in places]
    digests = [hashlib.sha256(b";".join([texts_of[c] for c in codes[a:b].tolist()])).hexdigest() if ok else ""
               for ok, a, b in zip(good.tolist(), rows[:-1].tolist(), rows[1:].tolist())]
    doc = np.repeat(np.arange(len(empty)), np.diff(rows))
    kept = good[doc]
    seen, times = np.unique(doc[kept] * len(own) + codes[kept], return_counts=True)
    which, of_doc = seen % max(1, len(own)), seen // max(1, len(own))
    links = [lexicon.links[i] for i in places]
    sizes = own[:, 3]
    each = sizes[which]
    total = int(each.sum())
    at = np.repeat((np.cumsum(sizes) - sizes)[which] - (np.cumsum(each) - each), each) + np.arange(total)
    pairs = np.frombuffer(b"".join([raw if ok else b"" for raw, ok in zip(links, own[:, 4].tolist())]), dtype="<u4")[at].astype(np.uint64)
    keys = pairs << np.uint64(32) | np.repeat(of_doc + first_doc, each).astype(np.uint64)
    return counts, digests, combined(keys, np.repeat(times, each))


def _runs_of(group: pa.Table) -> list[tuple[int, list[int], list[bytes]]]:
    group = group.sort_by([("origin", "ascending"), ("run", "ascending")])
    return list(zip(group["origin"].to_pylist(), group["firsts"].to_pylist(), group["blocks"].to_pylist()))


_PAIRS = pa.schema([("bucket", pa.int32()), ("pair", pa.int64()), ("count", pa.int64())])
_SHARES = pa.schema([("origin", pa.int32()), ("doc", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _count(group: pa.Table) -> pa.Table:
    """Links of every pair within the runs of one bucket's part."""
    pairs, counts = [], []
    for keys, numbers, _ in merge(_runs_of(group)):
        found, sums = combined(keys >> np.uint64(32), numbers)
        pairs.append(found)
        counts.append(sums)
    found, sums = combined(np.concatenate(pairs), np.concatenate(counts))
    return pa.table([pa.array(np.full(len(found), group["bucket"][0].as_py(), np.int32)), pa.array(found.astype(np.int64)), pa.array(sums)], schema=_PAIRS)


def _share(runs: pa.Table, counted: pa.Table) -> pa.Table:
    """What the records of one bucket's part add to their documents. The pairs of a B id follow each other, so their maximum is at hand."""
    if not runs.num_rows:
        return _SHARES.empty_table()
    counted = counted.sort_by("pair")
    pairs, counts = counted["pair"].to_numpy().astype(np.uint64), counted["count"].to_numpy()
    side = pairs >> np.uint64(16)
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    best = counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))
    docs, shares = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    waiting, size = [], 0
    for keys, numbers, origins in merge(_runs_of(runs)):
        place = np.searchsorted(pairs, keys >> np.uint64(32))
        waiting.append((origins << 32 | (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), np.stack([numbers * best[place], numbers * counts[place]], axis=1)))
        size += len(keys)
        if size > len(docs) + 8 * CHUNK:
            docs, shares, waiting, size = *_by_doc(docs, shares, waiting), [], 0
    docs, shares = _by_doc(docs, shares, waiting)
    return pa.table([pa.array((docs >> 32).astype(np.int32)), pa.array((docs & 0xFFFFFFFF).astype(np.int32)), pa.array(shares[:, 0]), pa.array(shares[:, 1])],
                    schema=_SHARES)


def _by_doc(docs: np.ndarray, shares: np.ndarray, waiting: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    docs, shares = np.concatenate([docs, *[w[0] for w in waiting]]), np.concatenate([shares, *[w[1] for w in waiting]])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(shares[order], first, axis=0)


def alignment(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, part_bytes: int = PART_BYTES,
              **sizes: int) -> tuple[DataFrame, DataFrame]:
    """The documents' rows and the pair table ``b_id, a_id, count, best`` (best: no pair of that B id has more).

    Each document is encoded by both tokenizers: A over a space and the text, B over the text. Tokens that share a byte are
    linked. A task spills its records of pair, document and links as sorted runs by radix of the B id; runs of a bucket are
    merged once to count pairs, and once more to hand counts back to documents. Large buckets are dealt over
    parts, whose counts are added. ``sizes`` are the limits of ``spill``. Null and empty texts, and texts whose tokens do not spell them, give zeros and no digest.
    Repeated rows count each. Columns other than ``doc_id`` and ``text`` are not read.
    """
    spilled = spill(docs, byte_path, piece_path, **sizes)
    every = spilled.filter("bucket IS NOT NULL").select("origin", "run", "bucket", "bytes", "firsts", "blocks")
    size = F.create_map(*[F.lit(x) for r in every.groupBy("bucket").agg(F.sum("bytes").alias("n")).collect()
                          for x in (r["bucket"], -(-r["n"] // part_bytes))], F.lit(-1), F.lit(1))
    runs = every.withColumn("part", F.pmod(F.xxhash64("origin", "run"), size[F.col("bucket")]).cast("int"))
    partial = runs.groupBy("bucket", "part").applyInArrow(_count, "bucket int, pair long, count long")
    pairs = materialize(partial.groupBy("bucket", "pair").agg(F.sum("count").alias("count")), "pairs")
    copies = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), (size[F.col("bucket")] - 1).cast("int"))))
    shares = runs.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part")).applyInArrow(
        _share, "origin int, doc int, n_best long, count_sum long")
    total = shares.groupBy("origin", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = spilled.filter("bucket IS NULL").join(total, ["origin", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    ids = pairs.select(F.shiftright("pair", 16).cast("int").alias("b_id"), F.col("pair").bitwiseAND(0xFFFF).cast("int").alias("a_id"), "count")
    most = ids.groupBy("b_id").agg(F.max("count").alias("most"))
    return rows, ids.join(most, "b_id").select("b_id", "a_id", "count", (F.col("count") == F.col("most")).alias("best"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))[0]
