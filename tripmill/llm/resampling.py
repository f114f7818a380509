"""Importance resampling of documents towards a target text.

Hashed runs of words are counted in the corpus and in the target; the log of their ratio is a
bucket's gain, a document's weight is the mean gain of its runs, and Gumbel noise on the weights
turns the highest scores into a draw without replacement.

Texts are handled in batches: joined with a separator that is no part of a word, found by one
regular expression over the whole batch. The place of each word among the texts' offsets tells its
text, and runs that begin and end in different texts are masked out before anything is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches, row_groups, stored
from tripmill.operators.sequence import in_parts, running_total

# Everything but ASCII other than 0-9 and a-z; whatever is not ASCII is bytes from 0x80 in UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
SEPARATOR = b"\n"
# Bytes of joined texts whose words are Python objects at the same time.
WINDOW = 1 << 20


def hashed_runs(texts: list[bytes | None], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words of a run, text numbers, CRC-32 values) for all runs of 1 to `most` words.

    A window of the joined texts ends between words and hands its last words to the next one, so a
    long text is never more than a window of words.
    """
    joined = SEPARATOR.join([t or b"" for t in texts]).lower()
    offsets = np.cumsum([0] + [len(t or b"") + 1 for t in texts[:-1]])
    held_words, held_starts, at = [], [], 0
    while at < len(joined):
        gap = NO_WORD.search(joined, at + WINDOW)
        end = gap.start() if gap else len(joined)
        words, starts = list(held_words), list(held_starts)
        for match in WORD.finditer(joined, at, end):
            words.append(match.group())
            starts.append(match.start())
        rows = np.searchsorted(offsets, np.array(starts, np.int64), "right") - 1
        values, spaced = list(map(crc32, words)), [b" " + w for w in words]
        for length in range(1, most + 1):
            if length > 1:
                values = list(map(crc32, islice(spaced, length - 1, None), values))
            first = max(0, len(held_words) - length + 1)
            begin, last = rows[: len(values)][first:], rows[length - 1 :][first:]
            same = begin == last
            yield length, begin[same], np.array(values[first:], np.uint32)[same]
        kept = max(0, len(words) - most + 1)
        held_words, held_starts, at = words[kept:], starts[kept:], end


def bucket_counts(texts: DataFrame, buckets: int, most: int, column: str) -> DataFrame:
    """(bucket, n): how many runs of all texts fall into each bucket; empty buckets are left out.

    A task sends one number per bucket.
    """

    def run(batches: Batches) -> Batches:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in row_groups(batch, "text"):
                cells = group.column("text").cast(pa.binary()).to_pylist()
                for _, _, values in hashed_runs(cells, most):
                    counts += np.bincount(values % buckets, minlength=buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(counts[filled])], ["bucket", "n"]
        )

    rows = texts.select(F.col(column).alias("text")).filter("text is not null")
    found = map_batches(rows, run, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares: `buckets` numbers."""
    sums = []
    for counts in (corpus, target):
        found = np.zeros(buckets)
        rows = counts.toArrow()
        found[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        sums.append(found)
    own, wanted = sums
    ratio = (wanted + 1) * (own.sum() + buckets) / ((own + 1) * (wanted.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, most: int, key: str, column: str) -> DataFrame:
    """(key, n_words, n_features, weight) of every row; the weight is the floored mean gain."""
    buckets = len(gain)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for group in row_groups(batch, "text"):
                cells = group.column("text").cast(pa.binary()).to_pylist()
                words, features, sums = (np.zeros(len(cells), np.int64) for _ in range(3))
                for length, rows, values in hashed_runs(cells, most):
                    here = np.bincount(rows, minlength=len(cells))
                    words += here if length == 1 else 0
                    features += here
                    of_rows = np.bincount(rows, gain[values % buckets], len(cells))
                    sums += of_rows.astype(np.int64)
                weights = np.where(features > 0, sums // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [group.column(key), *map(pa.array, (words, features, weights))],
                    [key, "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col(key), F.col(column).alias("text"))
    schema = rows.select(
        key, *[F.lit(0).cast("long").alias(c) for c in ("n_words", "n_features", "weight")]
    ).schema
    return map_batches(rows, run, schema)


def gumbel(seed: int, key: str | Column) -> Column:
    """Thousandths of Gumbel noise from a hash of seed and key; a null key counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    share = (number + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    buckets: int = 10_000,
    most: int = 2,
    least_words: int = 20,
    seed: int = 7,
    key: str = "doc_id",
    column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row of `docs`.

    Words are lower-cased in A-Z alone. Of the rows with at least `least_words` words, `percent` of
    a hundred, rounded down, get a rank: the highest scores, equal ones by the smaller key and null
    keys last; the other rows' rank is null. A null or empty text has no features and weight 0, an
    empty target text the smoothed share of an empty count. Repeated rows have the same score and
    ranks next to each other. Extra columns are left out, whatever they are called; an empty table
    gives an empty one. Texts of any length are read in windows of a megabyte.
    """
    own = bucket_counts(docs, buckets, most, column)
    gain = gains(own, bucket_counts(target, buckets, most, target_column), buckets)
    rows = weighed(docs, gain, most, key, column)
    rows = rows.withColumn("score", F.col("weight") + gumbel(seed, key))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "resampling-scores")
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last(key), F.asc("row")]
    parted = in_parts(rows.filter(enough), order, "resampling-order")
    ranked = running_total(parted, [], order, F.lit(1).cast("long"), "rank")
    drawn = rows.agg(F.count_if(enough)).first()[0] * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = rows.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    names = [key, "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(others.select(*names))
