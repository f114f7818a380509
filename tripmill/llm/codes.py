"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

Codebooks are learnt by rounds of assignment and integer means; vectors are integers, so every
distance is exact. The nearest entry is found by an equal-average search: a part and an entry whose
component sums differ by g are at least g * g / d apart in squared distance, d components each. The
entries are kept in order of their sums; from a part's own sum the search goes outwards, nearer sums
first, and ends once g * g / d is greater than the best distance found. An entry at exactly that
bound can still be a tie, so it is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches, stored, without
from tripmill.llm.vectors import matrix

FAR = np.int64(np.iinfo(np.int64).max)


@dataclass(frozen=True)
class Codebook:
    """The entries of one part position, also in order of their sums."""

    entries: np.ndarray
    order: np.ndarray
    sums: np.ndarray

    @staticmethod
    def of(entries: np.ndarray) -> Codebook:
        sums = entries.sum(1)
        order = np.argsort(sums, kind="stable")
        return Codebook(entries, order, sums[order])


def nearest(parts: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, its squared distance, distances computed) of each row.

    Equal distances go to the lower index. In each step every row that is still searching looks at
    its next entry outwards, below or above; rows that are done leave the arrays.
    """
    count, size = len(book.entries), parts.shape[1]
    own = parts.sum(1)
    best = np.full(len(parts), FAR)
    index = np.full(len(parts), count, np.int64)
    above = np.searchsorted(book.sums, own)
    below = above - 1
    rows, looked = np.arange(len(parts)), 0
    while len(rows):
        low, high = below[rows], above[rows]
        gap_low = np.where(low >= 0, own[rows] - book.sums[np.maximum(low, 0)], FAR)
        gap_high = np.where(
            high < count, book.sums[np.minimum(high, count - 1)] - own[rows], FAR
        )
        down = gap_low <= gap_high
        gap = np.where(down, gap_low, gap_high)
        left = gap != FAR
        # gap * gap / size > best, in whole numbers; a first entry is always looked at.
        squares = np.where(left, gap, 0) ** 2
        left &= (index[rows] == count) | (squares <= best[rows] * size)
        rows, down, low, high = rows[left], down[left], low[left], high[left]
        entry = book.order[np.where(down, low, high)]
        distance = ((parts[rows] - book.entries[entry]) ** 2).sum(1)
        looked += len(rows)
        nearer = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
        best[rows[nearer]], index[rows[nearer]] = distance[nearer], entry[nearer]
        below[rows] -= down
        above[rows] += ~down
    return index, best, looked


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end; the first ones take what does not divide."""
    sizes = [length // parts + (i < length % parts) for i in range(parts)]
    ends = np.cumsum(sizes).tolist()
    return [(end - size, end) for size, end in zip(sizes, ends, strict=True)]


def whole_vectors(vectors: DataFrame, scale: int, parts: int, column: str) -> DataFrame:
    """The rows of usable vectors with `whole`: components times scale, floored.

    No sum, gap or distance of admitted components leaves 64 bits, nor does the bound's product.
    """
    wrong = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = vectors.withColumn("vector", F.col(column).cast("array<double>"))
    rows = rows.filter("vector is not null").filter(~wrong)
    length = F.size("vector")
    limit = F.lit(float(1 << 29)) / F.greatest(F.ceil(length / parts), F.sqrt(length), F.lit(1))
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    safe = F.forall("vector", lambda x: F.abs(x * scale) < limit)
    told = F.raise_error(F.lit("a vector's component is too large for exact 64-bit distances"))
    rows = rows.withColumn("whole", F.when(safe, whole).otherwise(told.cast("array<bigint>")))
    return rows.drop("vector")


def _assigned(rows: DataFrame, books: list[Codebook], places: list[tuple[int, int]]) -> DataFrame:
    """(part, entry, place, total, n): sums of the components that each entry is nearest to.

    A task sends one row per component of a codebook.
    """

    def run(batches: Batches) -> Batches:
        totals = [np.zeros(b.entries.shape, np.int64) for b in books]
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        for batch in batches:
            table = matrix(batch.column("whole"), "int64")
            for part, (start, end) in enumerate(places):
                index, _, _ = nearest(table[:, start:end], books[part])
                np.add.at(totals[part], index, table[:, start:end])
                counts[part] += np.bincount(index, minlength=len(counts[part]))
        for part, total in enumerate(totals):
            entry, place = (x.ravel() for x in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(total.size, part, np.int32)),
                    pa.array(entry.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(total.ravel()),
                    pa.array(np.repeat(counts[part], total.shape[1])),
                ],
                ["part", "entry", "place", "total", "n"],
            )

    found = map_batches(
        rows.select("whole"), run, "part int, entry int, place int, total long, n long"
    )
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    return found.filter("n > 0").groupBy("part", "entry", "place").agg(*exact)


def learnt(
    rows: DataFrame, first: list[list[int]], parts: int, rounds: int
) -> tuple[list[Codebook], list[tuple[int, int]]]:
    """Codebooks after `rounds` rounds, beginning with the parts of the `first` vectors.

    The driver holds the codebooks alone.
    """
    start = np.array(first, np.int64)
    places = cuts(start.shape[1], parts)
    books = [Codebook.of(start[:, a:b]) for a, b in places]
    for _ in range(rounds):
        entries = [b.entries.copy() for b in books]
        for part, entry, place, total, n in _assigned(rows, books, places).collect():
            entries[part][entry, place] = int(total) // int(n)
        books = [Codebook.of(e) for e in entries]
    return books, places


def coded(
    rows: DataFrame, books: list[Codebook], places: list[tuple[int, int]], kept: list[str]
) -> DataFrame:
    """The kept columns with `code`, one byte array of indexes, and `error`."""
    schema = rows.select(
        *kept, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")
    ).schema

    def run(batches: Batches) -> Batches:
        for batch in batches:
            table = matrix(batch.column("whole"), "int64")
            codes = np.zeros((len(table), len(places)), np.uint8)
            errors = np.zeros(len(table), np.int64)
            for part, (start, end) in enumerate(places):
                codes[:, part], distance, _ = nearest(table[:, start:end], books[part])
                errors += distance
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(errors),
                ],
                [*kept, "code", "error"],
            )

    return map_batches(rows.select(*kept, "whole"), run, schema)


def written(books: list[Codebook]) -> str:
    """All entries' components by part, entry and place, joined by commas."""
    return ",".join(str(x) for b in books for x in b.entries.ravel().tolist())


def lengths_apart(rows: DataFrame) -> Iterator[tuple[int, DataFrame]]:
    """The rows of each vector length; only the lengths are collected."""
    size = F.size("whole")
    for (length,) in sorted(rows.select(size).distinct().collect()):
        yield length, rows.filter(size == length)


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    key: str = "vec_id",
    column: str = "embedding",
    label: str | Column | None = None,
) -> DataFrame:
    """(key, label, length, code, error, codebooks) of every usable vector.

    Rows whose vector is null or holds a null or non-finite component are left out; a null key is a
    row like any other, after the rest. Components are floored at `scale` times their value, so a
    code stands for a vector of integers (`decoded`); one too large for exact distances raises. The
    first entries are the vectors of the smallest keys, of equal keys the vector that sorts first,
    fewer if there are fewer rows. Vectors of each length have codebooks of their own; a length that
    does not divide gives its first parts one component more, and parts without components are
    all at entry 0. `code` holds one byte a part, so there are at most 256 entries; `codebooks` is
    their text. Repeated rows stay repeated, extra columns are left out whatever they are called, and
    an empty table gives an empty one.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    wanted = vectors.select(
        F.col(key).alias("id"),
        (F.lit(None).cast("string") if label is None else F.col(label)).alias("label"),
        F.col(column).alias("given"),
    )
    rows = stored(whole_vectors(wanted, scale, parts, "given").drop("given"), "codes-vectors")
    found = coded(rows.filter(F.lit(False)), [], [], ["id", "label"])
    found = found.withColumns({"length": F.lit(0), "codebooks": F.lit("")})
    for length, own in lengths_apart(rows):
        first = own.orderBy(F.asc_nulls_last("id"), "whole").limit(entries).select("whole")
        books, places = learnt(own, [r[0] for r in first.collect()], parts, rounds)
        part = coded(own, books, places, ["id", "label"])
        text = F.lit(written(books))
        found = found.unionByName(part.withColumns({"length": F.lit(length), "codebooks": text}))
    return found.select(F.col("id").alias(key), "label", "length", "code", "error", "codebooks")


def group_errors(codes: DataFrame) -> DataFrame:
    """The rows of `compress` with `label_error`: the errors summed over equal labels, nulls too."""
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = stored(sums, "codes-labels")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


@lru_cache(8)
def _entries(text: str, length: int, parts: int) -> list[np.ndarray]:
    """The entries of each part from the text of the codebooks."""
    numbers = np.array(text.split(",") if text else [], np.int64)
    count = len(numbers) // length if length else 1
    sizes = [end - start for start, end in cuts(length, parts)]
    ends = np.cumsum(sizes) * count
    return [
        numbers[end - size * count : end].reshape(count, size)
        for size, end in zip(sizes, ends, strict=True)
    ]


def decoded(codes: DataFrame) -> DataFrame:
    """The rows of `compress` with `approximate`: the vector of integers that the code stands for.

    A column of that name gives way.
    """
    codes = without(codes, "approximate")
    empty = F.array().cast("array<bigint>").alias("approximate")
    schema = codes.select("*", empty).schema

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("code", "length", "codebooks")]
            found = []
            for code, length, text in zip(*columns, strict=True):
                books = _entries(text, length, len(code))
                parts = [book[entry] for book, entry in zip(books, code, strict=True)]
                found.append(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int64()))], schema.names
            )

    return map_batches(codes, run, schema)
