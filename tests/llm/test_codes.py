from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill.llm import codes, queries

VECTORS = "vec_id long, embedding array<double>, label int"


def vectors(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


def test_query_against_sql(spark, data_dir):
    got = rows_of_spark(queries.op12_vector_codes(spark, data_dir))
    assert got == rows_of_sql(connect(data_dir), queries.CODES_SQL)


@pytest.mark.parametrize("spread", [1, 3, 100])
def test_nearest_against_all_distances(spread):
    random = np.random.default_rng(spread)
    for size, count in ((1, 5), (3, 16), (8, 16), (8, 1)):
        parts = random.integers(-spread, spread + 1, (500, size))
        entries = random.integers(-spread, spread + 1, (count, size))
        index, error, looked = codes.nearest(parts, codes.Codebook.of(entries))
        distance = ((parts[:, None] - entries) ** 2).sum(2)
        assert (index == distance.argmin(1)).all() and (error == distance.min(1)).all()
        assert looked <= distance.size


def test_search_ends_early():
    random = np.random.default_rng(5)
    entries = random.integers(-4096, 4096, (16, 1)) * np.ones((1, 8), np.int64)
    parts = entries[random.integers(0, 16, 1000)] + random.integers(-9, 10, (1000, 8))
    _, _, looked = codes.nearest(parts, codes.Codebook.of(entries))
    assert looked < 3 * len(parts)


def plain(rows, parts, entries, rounds, scale):
    """The plain form over (id, vector) rows in order of their ids."""
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    out, errors, books = ["" for _ in whole], [0] * len(whole), []
    for start, end in codes.cuts(len(whole[0]), parts):
        cut = [v[start:end] for v in whole]
        book = [list(c) for c in cut[:entries]]

        def best(c):
            found = [sum((x - y) ** 2 for x, y in zip(c, b)) for b in book]
            return found.index(min(found)), min(found)

        for _ in range(rounds):
            owner = [best(c)[0] for c in cut]
            for e in range(len(book)):
                mine = [c for c, o in zip(cut, owner) if o == e]
                if mine:
                    book[e] = [sum(x) // len(mine) for x in zip(*mine)]
        for i, c in enumerate(cut):
            e, d = best(c)
            out[i] += f"{e:02x}"
            errors[i] += d
        books += [x for b in book for x in b]
    return out, errors, ",".join(map(str, books))


@pytest.mark.parametrize("length, parts, entries", [(8, 4, 4), (7, 3, 3), (2, 4, 16), (1, 1, 2)])
def test_against_the_plain_form(spark, length, parts, entries):
    random = np.random.default_rng(length)
    rows = [(i, [round(float(x), 2) for x in random.normal(size=length)]) for i in range(30)]
    rows += [(30 + i, rows[i][1]) for i in range(5)]
    made = vectors(spark, [(i, v, None) for i, v in rows]).repartition(4)
    got = codes.compress(made, parts, entries, 3, 16).orderBy("vec_id").collect()
    code, errors, books = plain(rows, parts, entries, 3, 16)
    assert [r["code"].hex() for r in got] == code
    assert [r["error"] for r in got] == errors
    assert {r["codebooks"] for r in got} == {books}


def test_decoded_vectors_are_as_far_as_told(spark):
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=9).tolist(), i % 2) for i in range(50)]
    found = codes.compress(vectors(spark, rows), parts=4, entries=8, scale=100)
    for row in codes.decoded(found.withColumn("approximate", F.lit(1))).collect():
        given = [math.floor(100 * x) for x in rows[row["vec_id"]][1]]
        assert sum((a - b) ** 2 for a, b in zip(given, row["approximate"])) == row["error"]


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0, 3.0, 4.0], 1),
        (1, [1.0, 2.0, 3.0, 4.0], 1),
        (2, None, 1),
        (3, [1.0, None, 3.0, 4.0], 1),
        (4, [1.0, float("nan"), 3.0, 4.0], None),
        (5, [1.0, float("-inf"), 3.0, 4.0], None),
        (6, [0.0, 0.0], None),
        (7, [], None),
        (None, [9.0, 9.0, 9.0, 9.0], None),
    ]
    made = vectors(spark, rows).withColumns({"code": F.lit("mine"), "whole": F.lit(1)})
    found = codes.group_errors(codes.compress(made, 2, 2, 2, 10, label="label"))
    got = sorted(((r["vec_id"], r["length"], r["code"].hex()) for r in found.collect()), key=repr)
    # The equal first entries: the lower takes all in the first round, then only the last row.
    assert got == [(1, 4, "0101"), (1, 4, "0101"), (6, 2, "0000"), (7, 0, "0000"), (None, 4, "0000")]
    sums = {(r["label"], r["label_error"]) for r in found.collect()}
    assert len(sums) == 2
    empty = codes.compress(vectors(spark, []))
    assert empty.count() == 0 and "codebooks" in empty.columns


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="too large"):
        codes.compress(vectors(spark, [(1, [1e30, 0.0], None)])).count()
