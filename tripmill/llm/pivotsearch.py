"""Exact top-k by inner product with a table of distances to pivots.

Every vector's distances to many pivots are computed once and stored. For a query q and a vector x
the greatest |d(q, p) - d(x, p)| over the pivots p bounds their distance from below, and with the
lengths of both that bounds their inner product from above. Candidates are evaluated in the order
of that bound until the next bound is below the k-th score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches, stored
from tripmill.llm.vectors import Best, matrix, of_each_length, search, valid_vectors

PIVOTS = 32
# Rows, least by a hash of their id, among which the pivots are chosen.
PIVOT_SAMPLE = 512
# Rows and queries whose bounds are computed at once, and candidates evaluated at once.
ROWS_AT_ONCE, QUERIES_AT_ONCE, EVALUATED_AT_ONCE = 4096, 64, 128
# Integers of doubles up to here are exact.
EXACT = float(2**53)


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample that lie far apart: each is the farthest from those before it."""
    if not len(sample):
        return sample
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        gaps = np.linalg.norm(sample - sample[chosen[-1]], axis=1)
        nearest = np.minimum(nearest, gaps)
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of each row to each pivot, without the cancellation of the product form."""
    out = np.empty((len(rows), len(pivots)))
    for i, pivot in enumerate(pivots):
        out[:, i] = np.linalg.norm(rows - pivot, axis=1)
    return out


def pivot_table(whole: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, vector, to_pivots), stored. Vectors hold integers."""
    drawn = whole.orderBy(F.xxhash64(F.lit("pivot"), "vec_id"), "vec_id").limit(PIVOT_SAMPLE)
    sample = matrix(drawn.select("vector").toArrow().column(0).combine_chunks())
    far = whole.sparkSession.sparkContext.broadcast(spread_pivots(sample, pivots))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = matrix(batch.column("vector"))
            near = distances(rows, far.value)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * near.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), lists],
                ["vec_id", "vector", "to_pivots"],
            )

    schema = "vec_id long, vector array<double>, to_pivots array<double>"
    return stored(map_batches(whole, run, schema), "pivot-table")


def inner_products(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Integer products; in doubles where no sum can leave the exact integers."""
    if exact:
        return (rows @ query).astype(np.int64)
    return rows.astype(np.int64) @ query.astype(np.int64)


def _upper_bounds(
    row_far: np.ndarray, row_square: np.ndarray, far: np.ndarray, square: np.ndarray
) -> np.ndarray:
    """Upper bounds of the products of queries (rows of the result) and rows (columns)."""
    gap = np.zeros((len(far), len(row_far)))
    for pivot in range(far.shape[1]):
        np.maximum(gap, np.abs(far[:, pivot, None] - row_far[None, :, pivot]), out=gap)
    squares = square[:, None] + row_square[None, :]
    return (squares - gap * gap) / 2 + 1e-9 * squares + 1e-6


def local_search(block: pa.Table, k: int):
    """The function that finds the best `k` rows of a partition for each query of a block."""
    query_ids = block.column("vec_id").to_numpy()
    queries = matrix(block.column("vector").combine_chunks())
    far = matrix(block.column("to_pivots").combine_chunks())
    square = (queries * queries).sum(1)

    def run(batches: Batches) -> Batches:
        best = Best(len(query_ids), k, "int64")
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                ids = batch.column("vec_id").to_numpy()
                rows, row_far = matrix(batch.column("vector")), matrix(batch.column("to_pivots"))
                row_square = (rows * rows).sum(1)
                exact = max(square.max(), row_square.max(initial=0)) < EXACT / 4
                for first in range(0, len(query_ids), QUERIES_AT_ONCE):
                    some = slice(first, first + QUERIES_AT_ONCE)
                    bounds = _upper_bounds(row_far, row_square, far[some], square[some])
                    for i, bound in enumerate(bounds, first):
                        _evaluate(best, i, query_ids[i], queries[i], ids, rows, bound, exact)
        yield best.rows(query_ids)

    return run


def _evaluate(best, i, query_id, query, ids, rows, bound, exact) -> None:
    """Candidates in the order of their bounds, until no bound reaches the k-th score."""
    open_ = np.flatnonzero(bound >= best.least(i))
    open_ = open_[ids[open_] != query_id]
    order = open_[np.argsort(-bound[open_], kind="stable")]
    for start in range(0, len(order), EVALUATED_AT_ONCE):
        some = order[start : start + EVALUATED_AT_ONCE]
        if bound[some[0]] < best.least(i):
            return
        best.add(i, inner_products(rows[some], query, exact), ids[some])


def top_products(
    vectors: DataFrame,
    chosen: Column,
    k: int = 10,
    factor: int = 1024,
    key: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` greatest integer products of each chosen row.

    A component x becomes floor(factor * x). `chosen` is a condition on `vec_id`; a row is no
    candidate of its own id, nor of one whose vector has another length. Which rows take no part
    says `valid_vectors`; different vectors of one id are all candidates, and as chosen rows they
    share the `k` ranks of their id. Equal scores go by the smaller id; with fewer candidates all are returned, and
    an empty table gives an empty one. Scores must fit 64 bits.
    """
    whole = valid_vectors(vectors, key, column).select(
        "vec_id",
        F.transform("vector", lambda x: F.floor(x * factor).cast("double")).alias("vector"),
    )
    lengths = of_each_length(stored(whole, "pivot-vectors"), chosen)
    tables = (pivot_table(rows) for rows in lengths)
    spark = vectors.sparkSession
    return search(spark, tables, chosen, k, lambda block: local_search(block, k), "long")
