from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import empty, odd_documents, rows_of, with_clashing
from tripmill.llm import queries, tokenfile


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.WORD_BPE)


@pytest.fixture(scope="module")
def words():
    with open(queries.WORD_BPE, encoding="utf-8") as file:
        return tokenfile.WordTokenizer(file.read())


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text(max_size=80) | st.text(alphabet="aeT h'sdÉß1!.,\n\x1c\x85<|>", max_size=200))
)
def test_same_as_library(words, library, texts):
    texts = [*texts, "It's <|endoftext|>. <|ENDOFTEXT|>", "ΟΔΟΣ İ K. e.g. a.. b!?", None]
    counts, ids = words.encode_all(pa.array(texts, pa.string()), 1)
    expected = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


def test_forgotten_words(words, library, monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", 3)
    for text in ("One two, three four.", "five Six seven", "one five"):
        counts, ids = words.encode_all(pa.array([text]), 1)
        assert ids[:-1].tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_against_library(spark, data_dir, library):
    got = {row["doc_id"]: row for row in queries.op6_token_files(spark, data_dir).collect()}
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").orderBy("doc_id")
    start = 0
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        raw = np.array(ids, "<u4").tobytes()
        own = got[row["doc_id"]]
        assert (own["start"], own["n_tokens"]) == (start, len(ids))
        assert own["ids_crc32"] == zlib.crc32(raw)
        start += len(ids)


def test_odd_rows_round_trip(spark, tmp_path, library):
    path = str(tmp_path / "tokens")
    docs = with_clashing(odd_documents(spark))
    tokenfile.write_token_files(docs, path, queries.WORD_BPE, 1)
    rows = tokenfile.read_token_files(spark, path).orderBy("start").collect()
    assert len(rows) == docs.count()
    ids = [row["doc_id"] for row in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    reached = 0
    for row in rows:
        assert row["start"] == reached and row["n_tokens"] == len(row["ids"])
        assert row["ids"][-1] == 1
        reached += row["n_tokens"]
    texts = sorted((library.encode(d["text"] or "", add_special_tokens=False).ids + [1])
                   for d in docs.collect())
    assert sorted(row["ids"] for row in rows) == texts


def test_files_allow_reads_in_part(spark, tmp_path):
    path = tmp_path / "tokens"
    docs = odd_documents(spark)
    tokenfile.write_token_files(docs, str(path), queries.WORD_BPE, 1)
    file = pq.ParquetFile(next(path.glob("part-*.parquet")))
    group = file.metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    one = tokenfile.read_token_files(spark, str(path)).filter("doc_id = 3").select("n_tokens")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert one.count() == 1


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfile.write_token_files(empty(spark), path, queries.WORD_BPE, 1)
    assert rows_of(tokenfile.with_crc32(tokenfile.read_token_files(spark, path))) == []


def test_crc32(spark):
    rows = spark.createDataFrame([(1, [5, 6]), (2, [])], "doc_id long, ids array<int>")
    got = dict(tokenfile.with_crc32(rows.repartition(1)).collect())
    assert got == {1: zlib.crc32(b"\5\0\0\0\6\0\0\0"), 2: 0}
    assert tokenfile.with_crc32(rows.filter(F.lit(False))).collect() == []
