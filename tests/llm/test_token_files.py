"""Token files against the tokenizer on whole texts, and what the reader can skip."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridlore.llm import token_files
from gridlore.llm.token_files import encode, op13_orc_tokens, read_tokens, with_crc, write_tokens
from gridlore.session import new_path

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def force(rows):
    """``(doc_id, text)`` in file order to the contract's rows."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab Z'sté7ßÉ×.,-( \t\n\x0b\x0c̸　Σ́")), max_size=40)))
def test_words_one_by_one_give_the_ids_of_the_whole_text(texts):
    ids, at = encode(pa.array(texts, type=pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(text) for text in texts]


@pytest.mark.parametrize("files", [1, 5])
def test_files_hold_the_documents_in_order(spark, files):
    long = "lorem ipsum, dolor's 42 " * 9_000
    rows = [(7, "seven words here"), (3, None), (5, ""), (2, long), (9, "a <|endoftext|> b"), (2, "again two"), (8, " \t\n"), (None, "no id")]
    rows += [(4, "same row")] * 40
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, part int")
    folder = new_path(spark, "tokens")
    write_tokens(docs, folder, files=files)
    got = [tuple(r) for r in with_crc(read_tokens(spark, folder)).orderBy("start").collect()]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    two = [r for r in got if r[0] == 2]
    order = [long, "again two"] if two[0][2] > two[1][2] else ["again two", long]
    rest = sorted((r for r in rows if r[0] != 2), key=lambda r: -1 if r[0] is None else r[0])
    before = [r for r in rest if r[0] is None or r[0] < 2]
    assert got == force([*before, *[(2, t) for t in order], *rest[len(before):]])


def test_a_frequent_id_is_cut_over_files(spark):
    docs = spark.range(4000).selectExpr("5L AS doc_id", "'the same text' AS text").repartition(4)
    folder = new_path(spark, "tokens")
    write_tokens(docs, folder, files=4)
    rows = spark.read.orc(folder).groupBy("part").count().collect()
    assert sum(r["count"] for r in rows) == 4000 and max(r["count"] for r in rows) < 2500
    starts = [r["start"] for r in read_tokens(spark, folder).select("start").orderBy("start").collect()]
    assert starts == list(range(0, 4 * 4000, 4))


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "two"), ("a", "one")], "doc_id string, text string")
    folder = new_path(spark, "tokens")
    write_tokens(docs, folder)
    assert [r["doc_id"] for r in read_tokens(spark, folder, doc_type="string").orderBy("start").collect()] == ["a", "b"]
    empty = new_path(spark, "tokens")
    write_tokens(docs.limit(0), empty)
    assert with_crc(read_tokens(spark, empty, doc_type="string")).count() == 0


def test_reader_skips_stripes_by_statistics_and_bloom_filters(spark):
    docs = spark.range(30_000).selectExpr("id * 2 AS doc_id", "concat('word ', id) AS text")
    folder = new_path(spark, "tokens")
    write_tokens(docs, folder, files=3)
    found = read_tokens(spark, folder, doc_ids=[40_000])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [40000])" in plan or "EqualTo(doc_id,40000)" in plan, plan
    row = found.collect()[0]
    assert row["ids"] == ids_of("word 20000")
    stored = spark.read.orc(folder)
    assert scanned(stored.filter("doc_id = 40000")) <= token_files.INDEX_ROWS
    # odd ids lie within the statistics of most runs of rows: only the Bloom filters rule them out
    assert sum(scanned(stored.filter(f"doc_id = {odd}")) == 0 for odd in range(10_001, 10_041, 2)) >= 17


def scanned(df):
    """Rows the scan handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_query_equals_the_tokenizer_on_every_document(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = [tuple(r) for r in op13_orc_tokens(spark, folder).orderBy("doc_id").collect()]
    assert got == force(rows)
