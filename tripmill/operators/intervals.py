"""Interval join: pairs of rows of one key whose half-open time spans overlap.

Spans are indexed by buckets of time on levels, each four times as long as the one below. A span
belongs to the lowest level whose buckets are at least as long as itself, so it touches at most two
of them there, and at most two on each level above: the shorter span of a pair looks the longer one up
on the longer one's level. Neither very long spans nor a key with a third of all rows fill one task,
as buckets of one key are apart. Both spans of a pair touch the bucket in which the later one begins;
there, and only there, the pair is given out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 16
BASE_SECONDS = 64


def bucket_micros(level: Column, base_seconds: int) -> Column:
    """Length of a level's buckets; twice the level as a shift is four to its power."""
    return F.lit(base_seconds * 1_000_000).cast("long") * F.pow(F.lit(4.0), level).cast("long")


def bucket_of(micros: Column, size: Column) -> Column:
    """The bucket of an instant, in whole numbers; instants before 1970 have negative ones."""
    return F.call_function("div", micros - F.pmod(micros, size), size)


def level_of(start: Column, end: Column, base_seconds: int) -> Column:
    """The lowest level whose buckets are at least as long as the span."""
    length = end - start
    longer = [
        (length > F.lit(base_seconds * 1_000_000 * 4**level)).cast("int")
        for level in range(LEVELS - 1)
    ]
    return reduce(lambda a, b: a + b, longer)


def _spans(df: DataFrame, side: str, span: tuple[str, str], base_seconds: int) -> DataFrame:
    """The rows as `_<side>`, with their span in microseconds and their level; empty spans go."""
    start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in span)
    return df.filter(start < end).select(
        F.struct(*df.columns).alias(f"_{side}"),
        start.alias(f"_{side}_start"),
        end.alias(f"_{side}_end"),
        level_of(start, end, base_seconds).alias(f"_{side}_level"),
    )


def levels_of(spans: DataFrame, side: str) -> list[int]:
    """The levels that occur: at most `LEVELS` numbers."""
    found = spans.agg(F.sort_array(F.collect_set(f"_{side}_level"))).first()[0]
    return list(found)


def _touched(side: str, level: Column, base_seconds: int) -> Column:
    """(level, bucket) of the buckets of a level that a span touches."""
    size = bucket_micros(level, base_seconds)
    first, last = (bucket_of(t, size) for t in (F.col(f"_{side}_start"), F.col(f"_{side}_end") - 1))
    return F.transform(
        F.sequence(first, last), lambda b: F.struct(level.alias("level"), b.alias("bucket"))
    )


def _indexed(spans: DataFrame, side: str, base_seconds: int) -> DataFrame:
    touched = _touched(side, F.col(f"_{side}_level"), base_seconds)
    return spans.withColumn("_place", F.explode(touched))


def _looking(
    spans: DataFrame, side: str, levels: list[int], lowest: int, base_seconds: int
) -> DataFrame:
    """The spans once for each bucket they touch on the given levels from `lowest` above their own."""
    if not levels:
        return _indexed(spans, side, base_seconds).filter(F.lit(False))
    own = F.col(f"_{side}_level") + lowest
    places = [
        F.when(own <= level, _touched(side, F.lit(level), base_seconds)) for level in levels
    ]
    kept = F.filter(F.array(*places), lambda place: place.isNotNull())
    return spans.withColumn("_place", F.explode(F.flatten(kept)))


def overlapping(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    condition: Column | None = None,
    base_seconds: int = BASE_SECONDS,
) -> DataFrame:
    """(left, right): structs of every two rows with equal keys whose spans have a common instant.

    Spans begin at the first column and end before the second. Rows with a null key or bound, and
    spans that do not end after they begin, overlap nothing. Equal rows count separately. `condition`,
    on `left.…` and `right.…`, is checked with the overlap.
    """
    a = _spans(left, "a", left_span, base_seconds)
    b = _spans(right, "b", right_span, base_seconds)
    found = [
        _matched(_looking(a, "a", levels_of(b, "b"), 0, base_seconds), _indexed(b, "b", base_seconds),
                 keys, base_seconds),
        _matched(_indexed(a, "a", base_seconds), _looking(b, "b", levels_of(a, "a"), 1, base_seconds),
                 keys, base_seconds),
    ]
    pairs = found[0].unionByName(found[1])
    return pairs if condition is None else pairs.filter(condition)


def _matched(a: DataFrame, b: DataFrame, keys: Sequence[str], base_seconds: int) -> DataFrame:
    names = ["_level", "_bucket", *[f"_key{i}" for i in range(len(keys))]]

    def placed(df: DataFrame, side: str) -> DataFrame:
        found = [F.col("_place.level"), F.col("_place.bucket"), *[F.col(f"_{side}.{k}") for k in keys]]
        return df.withColumns(dict(zip(names, found, strict=True))).drop("_place")

    later = F.greatest("_a_start", "_b_start")
    here = bucket_of(later, bucket_micros(F.col("_level"), base_seconds)) == F.col("_bucket")
    pairs = placed(a, "a").join(placed(b, "b"), names)
    pairs = pairs.filter((later < F.least("_a_end", "_b_end")) & here)
    return pairs.select(F.col("_a").alias("left"), F.col("_b").alias("right"))
