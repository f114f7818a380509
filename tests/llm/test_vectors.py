from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows_of
from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill.llm import collisions, pivotsearch, queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_products(rows, chosen, k=10):
    out = []
    for q, a in rows.items():
        if chosen(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in rows.items() if c != q)
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def whole(vector):
    return [math.floor(1024 * float(np.float32(x))) for x in vector]


def test_products_against_sql(spark, data_dir):
    got = rows_of_spark(queries.op7_exact_top_k(spark, data_dir))
    assert got == rows_of_sql(connect(data_dir), queries.PRODUCTS_SQL)


@pytest.mark.parametrize("block, rows_at_once", [(3, 16), (4096, 4096)])
def test_products_with_ties_in_blocks(spark, monkeypatch, block, rows_at_once):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", block)
    monkeypatch.setattr(pivotsearch, "ROWS_AT_ONCE", rows_at_once)
    random = np.random.default_rng(1)
    data = {i: random.integers(-2, 3, 4) / 4 for i in range(150)}
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in data.items()], SCHEMA)
    got = rows_of(pivotsearch.top_products(frame, F.col("vec_id") % 10 == 0, 7))
    expected = plain_products({i: whole(v) for i, v in data.items()}, lambda q: q % 10 == 0, 7)
    assert got == sorted(expected, key=repr)


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]),
        (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [0.0, 0.0]), (7, [-1.0, 0.25]), (None, [1.0, 1.0]),
        (8, [1.0]), (9, []), (100, [0.25, -1.0]), (200, [0.25, -1.0]), (50, [2.0, 2.0]),
    ]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    return frame.withColumns({c: F.lit("mine") for c in ("vector", "to_pivots", "score", "rank")})


def test_odd_vectors(spark):
    valid = {0: [1, 0], 1: [0.5, 0.5], 6: [0, 0], 7: [-1, 0.25], 100: [0.25, -1], 200: [0.25, -1],
             50: [2, 2]}
    got = rows_of(pivotsearch.top_products(odd_vectors(spark), F.col("vec_id") % 100 == 0, 10))
    expected = plain_products({i: whole(v) for i, v in valid.items()}, lambda q: q % 100 == 0)
    assert got == sorted(expected, key=repr)
    near = collisions.nearest_cosines(odd_vectors(spark), F.col("vec_id") % 50 == 0, 5)
    del valid[6]
    want = []
    for q, a in valid.items():
        if q % 50 == 0:
            found = sorted(
                (-float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)), c)
                for c, b in valid.items() if c != q
            )
            want += [(q, r, c) for r, (_, c) in enumerate(found[:5], 1)]
    assert sorted((r[0], r[1], r[2]) for r in near.collect()) == sorted(want)


def test_repeated_ids_against_sql(spark, tmp_path):
    """Every vector of an id is a candidate, and a query of its own."""
    random = np.random.default_rng(2)
    rows = [(i % 150, random.normal(size=4).tolist(), 0) for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    pq.write_table(frame.toArrow(), f"{tmp_path}/embeddings.parquet")
    got = rows_of_spark(queries.op7_exact_top_k(spark, str(tmp_path)))
    assert got == rows_of_sql(connect(str(tmp_path)), queries.PRODUCTS_SQL)
    near = collisions.nearest_cosines(frame, F.col("vec_id") == 0, 2000).collect()
    assert len(near) == 3 * 397


def test_each_length_by_itself(spark):
    rows = [(i, [1.0 + i, 1.0], 0) for i in range(0, 30, 10)]
    rows += [(i, [1.0, 1.0 + i, 2.0], 0) for i in range(100, 150, 10)] + [(200, [], 0), (201, [], 0)]
    rows += [(0, [1.0, 2.0, 3.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for row in pivotsearch.top_products(frame, F.col("vec_id") % 100 == 0, 10).collect():
        got.setdefault(row["query_id"], []).append(row["vec_id"])
    assert {q: sorted(ids) for q, ids in got.items()} == {
        0: [10, 20, 100, 110, 120, 130, 140], 100: [0, 110, 120, 130, 140], 200: [201],
    }
    near = collisions.nearest_cosines(frame, F.col("vec_id") == 0, 10).collect()
    assert sorted(row["vec_id"] for row in near) == [10, 20, 100, 110, 120, 130, 140]
    assert sorted(row["rank"] for row in near) == list(range(1, 8))


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert pivotsearch.top_products(nothing, F.col("vec_id") % 100 == 0).collect() == []
    assert collisions.nearest_cosines(nothing, F.col("vec_id") % 50 == 0).collect() == []


def plain_cosines(spark, directory):
    rows = spark.read.parquet(f"{directory}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([row["vec_id"] for row in rows])
    data = np.array([row["embedding"] for row in rows], float)
    data /= np.linalg.norm(data, axis=1)[:, None]
    for i in np.flatnonzero(ids % 50 == 0):
        scores = data @ data[i]
        scores[i] = -9
        best = np.lexsort((ids, -scores))[:5]
        yield int(ids[i]), ids[best].tolist(), scores[best]


def test_recall_and_scores(spark, data_dir):
    found = {}
    for row in queries.op10_near_vectors(spark, data_dir).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    hits = total = 0
    for query, ids, scores in plain_cosines(spark, data_dir):
        own = dict(found[query])
        hits, total = hits + len(own.keys() & set(ids)), total + len(ids)
        for vec_id, score in zip(ids, scores):
            assert vec_id not in own or own[vec_id] == pytest.approx(score, abs=1e-12)
    assert hits / total >= 0.9


def test_recall_on_one_large_shard():
    """A whole shard of random vectors, the hardest case: no neighbour is much nearer than another."""
    random = np.random.default_rng(4)
    data = random.normal(size=(4096, 64))
    data /= np.linalg.norm(data, axis=1)[:, None]
    settings = collisions.Settings()
    directions = collisions.random_directions(64, settings)
    shard = collisions.Shard(data @ directions, data[::64] @ directions, settings)
    hits, shares = 0, []
    for i in range(0, 4096, 64):
        found = shard.candidates(i // 64, 6)
        scores = data @ data[i]
        scores[i] = -9
        hits += len(set(np.argsort(-scores)[:5]) & set(found))
        shares.append(len(found) / 4096)
    assert hits / (5 * 64) >= 0.93
    assert np.mean(shares) < 0.5
