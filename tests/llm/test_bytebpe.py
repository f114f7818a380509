from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import empty, odd_documents, rows_of, with_clashing
from tripmill.llm import bytebpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bytebpe.ByteBpe(bytebpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def library():
    lines = bytebpe.read_ranks(PATH).splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode_all([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="aeth n'sd1é!\n", max_size=600))
def test_same_as_library(codec, library, text):
    assert ids(codec, text) == library.encode_ordinary(text)


@pytest.mark.parametrize(
    "text", ["", "ab" * 700, "aaaaab" * 300, " " * 900 + "x", "日本" * 400, "<|endoftext|>"]
)
def test_long_pieces_and_specials(codec, library, text):
    assert ids(codec, text) == library.encode_ordinary(text)


def test_streamed_and_forgotten_pieces(codec, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "STREAMED_CHARS", 50)
    monkeypatch.setattr(bytebpe, "STREAMED_PIECES", 7)
    monkeypatch.setattr(bytebpe, "REMEMBERED", 5)
    texts = ["one two three " * 20, "short text", "four five six seven " * 30, None]
    got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode_all(texts)]
    assert got == [library.encode_ordinary(t or "") for t in texts]


def test_round_trip_of_odd_rows(spark, library):
    docs = with_clashing(odd_documents(spark))
    encoded = bytebpe.encode(docs, PATH, PATTERN, keep_text=True)
    assert {*docs.columns, "round_trip"} == set(encoded.columns)
    rows = bytebpe.decode(encoded, PATH, PATTERN).collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = row["text"] or ""
        assert bytes(row["decoded"]) == text.encode()
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert row["n_tokens"] == len(row["ids"]) // 4 and row["round_trip"]


def test_empty_table(spark):
    assert rows_of(bytebpe.encode(empty(spark), PATH, PATTERN)) == []


ODD = st.text(alphabet="aeth'śrvelmdLT  \n\t 　é日1٣½²!?’-😀\x1c\u0085", max_size=60)


@pytest.fixture(scope="module")
def searched():
    """The same pieces by a pattern that is searched for."""
    return bytebpe.ByteBpe(bytebpe.read_ranks(PATH), f"(?:{PATTERN})")


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=8), st.integers(1, 30))
def test_classes_cut_as_the_pattern_does(codec, searched, texts, size):
    assert codec.by_class and not searched.by_class
    with pytest.MonkeyPatch.context() as patch:
        expected = searched.encode_all(texts)
        assert codec.encode_all(texts) == expected
        patch.setattr(bytebpe, "STREAMED_CHARS", size)
        assert codec.encode_all(texts) == expected
        assert searched.encode_all(texts) == expected


def test_texts_are_not_searched_and_met_pieces_not_merged_again(codec, monkeypatch):
    monkeypatch.setattr(codec, "pattern", None)
    text = "one xqzjw two xqzjw's, three"
    expected = codec.encode_all([text])
    monkeypatch.setattr(codec, "merge_rows", None)
    assert codec.encode_all([text, None, text]) == [expected[0], b"", expected[0]]


def test_ids_of_slices_and_broken_ids(codec):
    texts = pa.array(["a b", None, "", "don't", "日本 x"]).slice(1, 4)
    ids = codec.encode_array(texts)
    assert codec.decode_array(ids).to_pylist() == [b"", b"", b"don't", "日本 x".encode()]
    with pytest.raises(ValueError):
        codec.decode_array(pa.array([b"\0\0\0"]))
