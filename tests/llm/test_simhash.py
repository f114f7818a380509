from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import documents, empty, odd_documents, rows_of, with_clashing
from tripmill.llm import queries, simhash
from tripmill.llm.components import lowest_reachable


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, bits):
    """Ids to the smallest id they reach, by comparing everything with everything."""
    ids = sorted(marks)
    values = np.array([marks[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {doc: ids[find(i)] for i, doc in enumerate(ids)}


def test_query_against_brute_force(spark, data_dir):
    got = queries.op8_simhash_near_duplicates(spark, data_dir).collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    marks = {row[0]: plain_fingerprint(row[1]) for row in docs}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == marks
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(marks, 3)


@pytest.mark.parametrize("bits", range(8))
def test_position_sets_cover_every_choice(bits):
    from itertools import combinations

    shared = simhash.BYTES - bits
    sets = [set(s) for s in simhash.position_sets(shared)]
    assert all(any(s <= set(c) for s in sets) for c in combinations(range(8), shared))


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_dense_and_sparse_marks(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(30)]
    marks = {c ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(4))) for c in centres * 9}
    marks = {m & (2**64 - 1) for m in marks} | {0, 7, 2**64 - 1}
    signed = [(m - 2**64 if m >> 63 else m,) for m in marks]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long"), 3)
    roots = dict(lowest_reachable(edges, "a", "b").collect())
    expected = plain_components({s: s & (2**64 - 1) for (s,) in signed}, 3)
    assert {s: roots.get(s, s) for (s,) in signed} == expected


def test_odd_rows(spark):
    docs = with_clashing(odd_documents(spark))
    got = rows_of(simhash.near_duplicates(docs))
    ids = {row[0]: row[2] for row in got}
    assert len(got) == docs.count()
    assert ids[1] == ids[2] == 1
    assert ids[4] == ids[5] == ids[6] == 4
    assert {row[2] for row in got if row[1] == 0} == {4}
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    survivors = [row["doc_id"] for row in kept.collect()]
    assert sorted(i for i in survivors if i is not None) == sorted({v for v in ids.values() if v})
    assert len(survivors) == len(set(survivors))


def test_only_null_ids_keep_one_row_a_group(spark):
    docs = documents(spark, [(None, "a b c d", "en", "x")] * 3 + [(None, None, None, None)])
    assert simhash.one_of_each_group(docs).count() == 2


def test_empty_table(spark):
    assert rows_of(simhash.near_duplicates(empty(spark))) == []
    assert rows_of(simhash.one_of_each_group(empty(spark))) == []
