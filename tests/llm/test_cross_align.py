"""Alignment of two tokenizers against whole-text encodings and all byte ranges."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridlore.llm import cross_align
from gridlore.llm.cross_align import _lexicon, alignment, describe, merge, op11_cross_tokenizer_alignment, pack, unpack

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_level():
    """Byte of every character of the byte-level alphabet."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


LEVEL = byte_level()


def tokens(text):
    """Ids and bytes of both sides, or nothing."""
    if not text:
        return [], []
    a = [(i, bytes(LEVEL[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        found = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        b.append((i, bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(side):
    ends = np.cumsum([len(x) for _, x in side]).tolist()
    return list(zip([0, *ends[:-1]], ends, [i for i, _ in side]))


def linked(a, b):
    return [(y, x) for s, e, x in spans(a) for t, f, y in spans(b) if s < f and t < e]


def groups(a, b):
    both = sorted({e for _, e, _ in spans(a)} & {e for _, e, _ in spans(b)})
    return ";".join("|".join(",".join(str(i) for s, e, i in spans(side) if low <= s and e <= high) for side in (a, b))
                    for low, high in zip([0, *both], both))


def force(texts):
    sides = [tokens(t) for t in texts]
    links = [linked(a, b) for a, b in sides]
    count = Counter(p for own in links for p in own)
    most = Counter()
    for (y, _), n in count.items():
        most[y] = max(most[y], n)
    return [(len(a), len(b), groups(a, b).count("|"), len(own), sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
             hashlib.sha256(groups(a, b).encode()).hexdigest() if a else "") for (a, b), own in zip(sides, links)]


ODD = [None, "", " ", "  a", "a ", " \t\n", "word", "don't stop", "a  b   c \n\n d", "naïve café 中文字 の", "x▁y ▁ z", "<|endoftext|> <s> </s> <unk> <0x41>",
       "  a　 b", "0xdeadbeef" * 30, "emoji \U0001f600\U0001f600 end", "word", "word", "\x00 a\x01 b", "a\r\nb\r\n c"]


@pytest.mark.parametrize("sizes", [{}, {"held": 50, "chunk": 8, "block_bytes": 500, "part_bytes": 200}])
def test_rows_and_pairs_as_by_force(spark, sizes):
    rng = np.random.default_rng(2)
    texts = [*ODD, " ".join(f"w{i}" for i in rng.integers(0, 50, 300)), *[" ".join(rng.choice(["the", "aligned", "Tokens", "x,", "unfoldable"], 9)) for _ in range(60)]]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a long, bucket string")
    rows, pairs = alignment(docs, **sizes)
    assert [tuple(r)[1:] for r in rows.orderBy("doc_id").collect()] == force(texts)
    count = Counter(p for t in texts for p in linked(*tokens(t)))
    most = {}
    for (y, _), n in count.items():
        most[y] = max(most.get(y, 0), n)
    assert {tuple(r) for r in pairs.collect()} == {(y, x, n, n == most[y]) for (y, x), n in count.items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab 's \n 　▁<>")), max_size=30), min_size=1))
def test_words_align_as_whole_texts(texts):
    counts, digests, _ = describe(pa.array(texts), _lexicon(None, None), 0)
    assert [(*c, d) for c, d in zip(counts.tolist(), digests)] == [(r[0], r[1], r[2], r[3], r[6]) for r in force(texts)]


def test_blocks_and_merge_round_trip(monkeypatch):
    monkeypatch.setattr(cross_align, "CHUNK", 10)
    rng = np.random.default_rng(4)
    runs, every = [], []
    for origin in range(7):
        keys = np.sort(rng.integers(0, 1 << 62, 95).astype(np.uint64))
        keys[40:60] = keys[40]
        numbers = rng.integers(1, 1 << 30, 95)
        k, n = unpack(pack(keys, numbers))
        assert (k == keys).all() and (n == numbers).all()
        runs.append((origin, keys[::10].astype(np.int64).tolist(), [pack(keys[i:i + 10], numbers[i:i + 10]) for i in range(0, 95, 10)]))
        every += zip(keys.tolist(), numbers.tolist(), [origin] * 95)
    got = [row for k, n, o in merge(runs) for row in zip(k.tolist(), n.tolist(), o.tolist())]
    assert [r[0] for r in got] == sorted(r[0] for r in every) and sorted(got) == sorted(every)


def test_empty_table_and_text_ids(spark):
    docs = spark.createDataFrame([("b", "one"), ("b", "one")], "doc_id string, text string")
    assert alignment(docs.limit(0))[0].count() == 0
    assert [tuple(r)[1:] for r in alignment(docs)[0].collect()] == force(["one", "one"])


def test_query_equals_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(1 << 30).collect())
    small = [(i, (t or "")[:300]) for i, t in docs]  # the brute force is quadratic in a text's tokens
    frame = spark.createDataFrame(small, "doc_id long, text string")
    assert [tuple(r)[1:] for r in alignment(frame)[0].orderBy("doc_id").collect()] == force([t for _, t in small])
    assert op11_cross_tokenizer_alignment(spark, folder).count() == len(docs)
