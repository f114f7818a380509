"""What the vector searches share: valid vectors, blocks of queries, merging of local results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches
from tripmill.sources.workdir import new_workdir

# Queries that are sent to all tasks at once: some megabytes with their precomputed numbers.
QUERY_BLOCK = 4096


def valid_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, vector) as doubles.

    Rows with a null id, a null vector, or a null or non-finite component take no part. Rows equal
    in id and vector are one; different vectors of one id are rows of their own.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    wrong = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return rows.filter("vec_id is not null and vector is not null").filter(~wrong).distinct()


def of_each_length(rows: DataFrame, chosen: Column) -> Iterator[DataFrame]:
    """The stored rows of each vector length that a chosen row has; only the lengths are collected."""
    size = F.size("vector").alias("size")
    for (length,) in sorted(rows.filter(chosen).select(size).distinct().collect()):
        yield rows.filter(F.size("vector") == length)


def matrix(column: pa.Array, kind: str = "float64") -> np.ndarray:
    """A list column of equally long rows as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def query_blocks(prepared: DataFrame, chosen: Column) -> Iterator[pa.Table]:
    """The chosen rows in blocks by a hash of their id, of about `QUERY_BLOCK` rows each."""
    queries = prepared.filter(chosen)
    count = queries.count()
    blocks = max(1, -(-count // QUERY_BLOCK))
    for block in range(blocks if count else 0):
        own = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)) == block
        yield queries.filter(own).toArrow()


def search(
    spark: SparkSession,
    tables: Iterable[DataFrame],
    chosen: Column,
    k: int,
    local: Callable[[pa.Table], Callable[[Batches], Batches]],
    score: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score): every chosen row against all rows of its table.

    Each table holds prepared vectors of one length. Block after block of queries goes to all tasks; `local(block)` makes the function that finds a
    partition's best `k` for each of them. These are stored, and the best of all partitions taken,
    equal scores by the smaller id; chosen rows of one id share their ranks. The driver holds one
    block at a time.
    """
    path, schema = new_workdir(spark, "search"), f"query_id long, vec_id long, score {score}"
    for prepared in tables:
        for block in query_blocks(prepared, chosen):
            found = map_batches(prepared, local(block), schema)
            found.write.mode("append").parquet(path)
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(path)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


class Best:
    """The best `k` (score, id) of each query so far."""

    def __init__(self, queries: int, k: int, kind: str):
        self.k = k
        self.scores = [np.zeros(0, kind) for _ in range(queries)]
        self.ids = [np.zeros(0, np.int64) for _ in range(queries)]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate((self.scores[query], scores))
        ids = np.concatenate((self.ids[query], ids))
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            enough = scores >= least
            scores, ids = scores[enough], ids[enough]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]

    def least(self, query: int) -> float:
        """What a candidate must reach to change the result."""
        scores = self.scores[query]
        return scores[-1] if len(scores) == self.k else -np.inf

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        counts = [len(x) for x in self.ids]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(query_ids, counts)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *self.ids])),
                pa.array(np.concatenate([self.scores[0][:0], *self.scores])),
            ],
            ["query_id", "vec_id", "score"],
        )
