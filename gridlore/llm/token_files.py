"""Token ids in ORC files: ascending documents, run-length encoded integers, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlore.llm.common import table
from gridlore.llm.kernels import LOWER, WHITE, byte_rows
from gridlore.session import new_path

#: Id that closes every document.
END = 1
#: Bytes of text encoded at once, and distinct stretches whose ids a task remembers.
BLOCK_BYTES, CACHED_WORDS = 4 << 20, 300_000
#: Bytes of a stripe, rows of an index entry, and false positives of the Bloom filters.
STRIPE_BYTES, INDEX_ROWS, FALSE_POSITIVES = 16 << 20, 1000, 0.01
#: Kinds of bytes.
OTHER, LETTER, DIGIT, MARK = range(4)
_KIND = np.array([LETTER if chr(i).isalpha() else DIGIT if chr(i).isdigit() else MARK if 32 < i < 127 and chr(i) != "'" else OTHER
                  for i in range(128)] + [OTHER] * 128, dtype=np.uint8)
#: Letters whose lower case is one letter and that no normal form changes.
_LETTER_BYTES = [*range(97, 123), *range(0x9F, 0xC0), 0xC3]
#: Lower case of such letters' bytes, and one symbol of ASCII for every byte of theirs in a word and another for it at the end.
_FOLD = np.array([i + 32 if 65 <= i <= 90 or 0x80 <= i <= 0x9E else i for i in range(256)], dtype=np.uint8)
_BODY, _LAST = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
_BODY[0x20] = 0x20
_BODY[_LETTER_BYTES] = [i for i in range(1, 128) if i != 0x20][:len(_LETTER_BYTES)]
_LAST[_LETTER_BYTES] = [i for i in range(1, 128) if i != 0x20][len(_LETTER_BYTES):2 * len(_LETTER_BYTES)]
#: The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [i for i in range(256) if i not in _PRINTED]
_LEVEL = [chr(i) if i in _PRINTED else chr(256 + _OTHERS.index(i)) for i in range(256)]
_LETTERS = re.compile(rb"(?:[a-zA-Z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")


class Words:
    """The ids of every distinct stretch of text a task has met."""

    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)).encode() or b"(?!)", re.IGNORECASE)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.ranks = self._ranks()
        self.ids: dict[bytes, bytes] = {}

    def _ranks(self):
        """The vocabulary's tokens of Latin letters for ``tiktoken``, which merges several times faster: a byte is one symbol, a word's last byte another.

        None where ids do not follow the order of merges.
        """
        import tiktoken

        model = json.loads(self.tokenizer.to_str())["model"]
        vocabulary, made = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
        ids = [vocabulary["".join(m)] for m in made]
        if model.get("end_of_word_suffix") != "</w>" or ids != sorted(ids) or not ids or ids[0] < len(vocabulary) - len(ids):
            return None
        level = {c: i for i, c in enumerate(_LEVEL)}
        ranks = {}
        for token, i in vocabulary.items():
            closed = token.endswith("</w>")
            raw = [level.get(c, 0) for c in (token[:-4] if closed else token)]
            codes = [*_BODY[raw[:-1]], (_LAST if closed else _BODY)[raw[-1]]] if raw else [0]
            if all(codes):
                ranks[bytes(codes)] = i
        return tiktoken.Encoding("letters", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})

    def find(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, four bytes each."""
        if len(self.ids) > CACHED_WORDS:
            self.ids.clear()
        found = list(map(self.ids.get, words))
        new = [word for word, known in zip(words, found) if known is None]
        letters = [word for word in new if word.isalpha() or _LETTERS.fullmatch(word)]
        self.ids.update(zip(letters, self._together(letters)))
        rest = [word for word in new if word not in self.ids]
        self.ids.update(zip(rest, self._each(rest)))
        return [self.ids[word] if known is None else known for word, known in zip(words, found)]

    def _each(self, words: list[bytes]) -> list[bytes]:
        texts = [word.decode("utf-8", "replace") for word in words]
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Runs of letters are one word each, closed by a token that ends words: they are encoded as one text."""
        if not words:
            return []
        if self.ranks is None:
            return self._each(words)
        text = _FOLD[np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)]
        text = np.where(np.append(text[1:] == 0x20, False), _LAST[text], _BODY[text])
        ids = self.ranks.encode_to_numpy(text[:-1].tobytes().decode("ascii"), disallowed_special=()).astype("<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)] if len(ends) == len(words) else self._each(words)


@lru_cache(maxsize=1)
def _words(path: str | None) -> Words:
    return Words(path)


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text is a range of its own."""
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield start, end
        start = end


def _stretches(data: np.ndarray, offsets: np.ndarray, fine: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes without white space, the starts of stretches the tokenizer treats apart, and the ``len + 1`` offsets of the rows.

    It drops white space and joins nothing across it. With ``fine`` a stretch also ends beside a digit, and between a letter
    and a mark of ASCII other than an apostrophe, as the tokenizer's own pattern does.
    """
    solid = ~WHITE[data]
    first = np.ones(len(data), dtype=bool)
    first[1:] = ~solid[:-1]
    if fine:
        kind = _KIND[data]
        two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) if len(data) else np.zeros(0, np.int64)
        kind[two] = kind[two + 1] = LETTER
        a, b = kind[:-1], kind[1:]
        first[1:] |= (a == DIGIT) | (b == DIGIT) | (a == LETTER) & (b == MARK) | (a == MARK) & (b == LETTER)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    place = np.concatenate([[0], np.cumsum(solid)])
    return data[solid], place[np.flatnonzero(first & solid)], place[offsets]


def encode(texts: pa.Array, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``END``, and the ``len + 1`` offsets of the texts.

    Every distinct stretch of a block is encoded once. Where a string of an added token stands in the block, in any case,
    stretches are whole words as written, and the tokenizer finds the added tokens.
    """
    words = _words(path)
    data, offsets = byte_rows(texts)
    fine = not words.added.search(data)
    data, starts, rows = _stretches(LOWER[data] if fine else data, offsets, fine)
    bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
    raw, cuts = byte_rows(coded.dictionary)
    raw, cuts = raw.tobytes(), cuts.tolist()
    ids = words.find([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
    sizes = np.array([len(x) >> 2 for x in ids], dtype=np.int64)
    which = coded.indices.to_numpy(zero_copy_only=False)
    each = sizes[which]
    last = np.cumsum(each)
    total = int(last[-1]) if len(last) else 0
    begin = (np.cumsum(sizes) - sizes)[which] - (last - each)
    flat = np.frombuffer(b"".join(ids), dtype="<u4")[np.repeat(begin, each) + np.arange(total)]
    at = np.concatenate([[0], last])[np.searchsorted(starts, rows)]
    return np.insert(flat, at[1:], END).astype("<u4"), at + np.arange(len(at))


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, files: int | None = None) -> None:
    """Writes ``docs`` (``doc_id, text``) as ORC files below ``folder``, one range of ascending ids a file.

    A row holds ``doc_id``, the number ``part`` of its file, ``before`` (ids of the file's earlier documents), ``n_tokens``
    and ``ids``. ORC stores the integers run-length encoded, statistics for every ``INDEX_ROWS`` rows and stripe, and a
    Bloom filter of the document ids beside them; a stripe can be read by its own task. Rows of one id are ordered by text, equal
    rows are each kept, null ids come first, a null text is empty. A frequent id is cut over files by text and row. Columns besides
    ``doc_id`` and ``text`` are not read. ``path`` is the vocabulary, ``files`` the number of files.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = ["doc_id", "tie", "row"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, end in text_blocks(batch.column(1)):
                ids, at = encode(batch.column(1)[start:end], path)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[start:end], pa.array(np.full(end - start, part, dtype=np.int32)), pa.array(at[:-1] + before),
                    pa.array(np.diff(at).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view("<i4")))],
                    names=["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(at[-1])

    out = dealt.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, part int, before long, n_tokens int, ids array<int>")
    (out.write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES).option("orc.create.index", "true")
     .option("orc.row.index.stride", INDEX_ROWS).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", FALSE_POSITIVES).orc(folder))


def read_tokens(spark: SparkSession, folder: str, doc_ids: Sequence | None = None, doc_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the files below ``folder``; ``start`` counts the ids of all documents before it.

    With ``doc_ids`` only these documents: the condition reaches the scan, where statistics and Bloom filters skip stripes
    and runs of rows. Starts need one row for each file, from the ``part`` and ``n_tokens`` columns alone; these rows are
    broadcast, fewer bytes than the list of files that every scan keeps on the driver.
    """
    stored = spark.read.schema(f"doc_id {doc_type}, part int, before long, n_tokens int, ids array<int>").orc(folder)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    rows = stored if doc_ids is None else stored.filter(F.col("doc_id").isin(list(doc_ids)))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``, the checksum of the ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<i4")).cast("B")
            at = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op13_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    write_tokens(docs, folder)
    return with_crc(read_tokens(spark, folder, doc_type=docs.schema["doc_id"].dataType.simpleString()))
