from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import documents, empty, odd_documents, with_clashing
from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill.llm import queries, suffixdedup, suffixes
from tripmill.llm.suffixes import Block


def plain(rows, length):
    """(id, bytes, spans, kept) of (id, text) rows; a null id comes after all others."""
    order = [float("inf") if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for key, text in zip(order, texts):
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            first[window] = min(key, first.get(window, key))
    out = []
    for (given, _), key, text in zip(rows, order, texts):
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] < key:
                gone[at : at + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((given, len(text), spans, kept))
    return sorted(out, key=repr)


def found(docs, length):
    got = suffixdedup.without_repeats(docs, length).collect()
    return sorted(
        (
            (r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
            for r in got
        ),
        key=repr,
    )


def test_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = rows_of_spark(queries.op13_suffix_dedup(spark, sf_dir))
    assert got == rows_of_sql(connect(sf_dir), queries.REPEATS_SQL)


def test_covers():
    for modulus, residues in suffixes.COVERS.items():
        assert {(a - b) % modulus for a in residues for b in residues} == set(range(modulus))


@pytest.mark.parametrize("length", [1, 2, 5, 14, 50])
def test_windows_in_suffix_order(length):
    draw = random.Random(length)
    for letters in ("a", "ab", "abcd", "abcdefghijklmnopqrstuvwxyz"):
        for _ in range(20):
            data = "".join(draw.choices(letters, k=draw.randint(1, 300))).encode()
            if draw.random() < 0.5:
                data = data[: len(data) // 2] * 3
            cut = draw.randint(0, len(data))
            block = Block(data, np.array([cut, 0, len(data) - cut]), np.arange(3), length)
            at = np.flatnonzero(block.windows)
            at = at[[draw.random() < 0.7 for _ in at]]
            ordered, new = suffixes.sorted_windows(block, at)
            windows = [data[i : i + length] for i in ordered]
            assert sorted(ordered.tolist()) == at.tolist()
            assert windows == sorted(windows)
            assert new[1:].tolist() == [a != b for a, b in zip(windows, windows[1:])]


@pytest.mark.parametrize("length, letters", [(1, "ab"), (4, "abc"), (9, "ab"), (50, "ab€")])
def test_against_the_plain_form(spark, monkeypatch, length, letters):
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", 600)
    monkeypatch.setattr(suffixdedup, "BUCKET_BYTES", 500)
    draw = random.Random(length)
    passages = ["".join(draw.choices(letters, k=draw.randint(1, 3 * length))) for _ in range(6)]
    rows = []
    for number in range(60):
        own = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(4)]
        rows.append((number % 50, draw.choice(passages).join(own)))
    rows += [(7, None), (None, passages[0] * 2), (None, passages[0] * 2), (8, "")]
    draw.shuffle(rows)
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3)
    assert found(docs, length) == plain(rows, length)


def test_hot_passage_and_copies(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffixdedup, "BUCKET_BYTES", 2000)
    passage = "the same passage stands in every third of all documents of the table, whatever else"
    rows = [(i, f"own words {i * i} " + (passage if i % 3 == 0 else "x" * 30)) for i in range(300)]
    rows += [(1000 + i, "a whole document that was copied many times over " * 3) for i in range(200)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    assert found(docs, 50) == plain(rows, 50)


def test_odd_rows(spark):
    docs = with_clashing(odd_documents(spark))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, 50) == plain(rows, 50)
    assert suffixdedup.without_repeats(docs).columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert suffixdedup.without_repeats(empty(spark)).count() == 0


def test_query_columns(spark, tmp_path):
    text = "to be or not to be, that is the question that stands in both of them"
    documents(spark, [(1, text, "en", "a"), (2, "so: " + text + "!", "en", "a")]).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    rows = {r["doc_id"]: r for r in queries.op13_suffix_dedup(spark, str(tmp_path)).collect()}
    assert rows[1]["n_removed"] == 0
    assert (rows[2]["n_removed"], rows[2]["n_spans"]) == (len(text), 1)
    assert rows[2]["kept_sha256"] == hashlib.sha256(b"so: !").hexdigest()
