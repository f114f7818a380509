"""Approximate nearest neighbours by counting collisions in single projections.

The unit vectors of a shard of rows are projected onto many random directions, and the shard is
sorted along each. A query's windows, centred on its own projections, widen level by level (virtual
rehashing: nothing is hashed anew); a row collides once in each direction whose window holds it.
Rows that collide in more directions than a threshold are candidates. When a shard has enough of
them, their cosines are computed on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tripmill.llm.common import Batches, stored
from tripmill.llm.vectors import Best, matrix, of_each_length, search, valid_vectors

# Rows of a shard; its sorted arrays take 8 bytes for each row and direction.
SHARD_ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """`verified` is the share of a shard that must pass the threshold before widening ends."""

    directions: int = 64
    threshold: float = 0.75
    verified: float = 0.1
    first_width: float = 1.0
    widening: float = 1.1
    seed: int = 5


def random_directions(dimensions: int, settings: Settings) -> np.ndarray:
    """Random orthogonal bases side by side, scaled so that unit vectors spread with deviation 1."""
    random = np.random.default_rng(settings.seed)
    bases = -(-settings.directions // max(dimensions, 1))
    found = [np.linalg.qr(random.normal(size=(dimensions, dimensions)))[0] for _ in range(bases)]
    return np.concatenate(found, 1)[:, : settings.directions] * np.sqrt(dimensions)


def local_search(block: pa.Table, k: int, settings: Settings):
    """The function that finds near rows of a partition for each query of a block."""
    query_ids = block.column("vec_id").to_numpy()
    queries = matrix(block.column("vector").combine_chunks())
    lengths = np.linalg.norm(queries, axis=1)
    directions = random_directions(queries.shape[1], settings)
    centres = queries / lengths[:, None] @ directions

    def run(batches: Batches) -> Batches:
        best = Best(len(query_ids), k, "float64")
        for whole in batches:
            for start in range(0, whole.num_rows, SHARD_ROWS):
                batch = whole.slice(start, SHARD_ROWS)
                ids, rows = batch.column("vec_id").to_numpy(), matrix(batch.column("vector"))
                norms = np.linalg.norm(rows, axis=1)
                shard = Shard(rows / norms[:, None] @ directions, centres, settings)
                for i in range(len(centres)):
                    found = shard.candidates(i, k + 1)
                    found = found[ids[found] != query_ids[i]]
                    products = (rows[found] * queries[i]).sum(1)
                    best.add(i, products / (norms[found] * lengths[i]), ids[found])
        yield best.rows(query_ids)

    return run


class Shard:
    """Sorted projections of some rows, and the windows of some queries in them."""

    def __init__(self, projected: np.ndarray, centres: np.ndarray, settings: Settings):
        self.rows, self.settings, self.centres = len(projected), settings, centres
        self.order = np.ascontiguousarray(projected.argsort(0).T)
        self.values = np.take_along_axis(projected.T, self.order, 1)
        self.needed = max(1, int(np.ceil(settings.threshold * projected.shape[1])))
        self.levels: list[tuple[list, list]] = []

    def windows(self, level: int) -> tuple[list, list]:
        """Where the windows of a level begin and end, by query and direction."""
        while len(self.levels) <= level:
            width = self.settings.first_width * self.settings.widening ** len(self.levels)
            ends = [
                [values.searchsorted(at - width), values.searchsorted(at + width)]
                for values, at in zip(self.values, self.centres.T, strict=True)
            ]
            low, high = np.array(ends).transpose(1, 2, 0)
            self.levels.append((low.tolist(), high.tolist()))
        return self.levels[level]

    def candidates(self, query: int, least: int) -> np.ndarray:
        """Rows that pass the collision threshold once enough of the shard does.

        A level counts only what its windows hold beyond those of the level before.
        """
        enough = min(self.rows, least + int(self.settings.verified * self.rows))
        counts, level = np.zeros(self.rows, np.int64), 0
        while True:
            lows, highs = self.windows(level)
            low, high = lows[query], highs[query]
            if level == 0:
                found = [o[a:b] for o, a, b in zip(self.order, low, high, strict=True)]
            else:
                found = [o[a:b] for o, a, b in zip(self.order, low, inner[0], strict=True)]
                found += [o[a:b] for o, a, b in zip(self.order, inner[1], high, strict=True)]
            counts += np.bincount(np.concatenate(found), minlength=self.rows)
            passed = np.flatnonzero(counts >= self.needed)
            if len(passed) >= enough:
                return passed
            inner, level = (low, high), level + 1


def nearest_cosines(
    vectors: DataFrame,
    chosen: Column,
    k: int = 5,
    settings: Settings = Settings(),
    key: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` rows of greatest cosine found for each chosen row.

    Every row is indexed and every shard is searched for every query, so a row is missed only if it
    stays below its shard's collision threshold. Scores are exact cosines of the original vectors in
    double precision. Zero vectors take no part; for other rows see `valid_vectors`. A row is no
    candidate of its own id, nor of one whose vector has another length. Different vectors of one id
    are all candidates, and as chosen rows they share the `k` ranks of their id. Equal scores go by the smaller id, and an empty table gives an empty
    one.
    """
    rows = valid_vectors(vectors, key, column).filter("exists(vector, x -> x <> 0)")
    lengths = of_each_length(stored(rows, "collision-vectors"), chosen)
    spark = vectors.sparkSession
    return search(
        spark, lengths, chosen, k, lambda block: local_search(block, k, settings), "double"
    )
