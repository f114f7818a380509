"""De-duplication with bounded state, for streams whose copies arrive within a known delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_copies_within(raw: DataFrame, delay: str, salts: int = 16) -> DataFrame:
    """One row per trip id among rows created within `delay` of each other: the first to arrive.

    State holds ids and not versions, so a later version of a trip is dropped like a copy. Where the
    latest version has to win, use the sink's look-up of stored trips instead.
    Rows created longer than `delay` before the newest one are dropped, new or not; where that may
    not happen use the sink's look-up of written ids. Rows without an id or a readable creation
    time cannot be told apart by either, so they pass by the de-duplication to the sink. Streaming
    de-duplication ships every row to its key's task, so the first pass works on (id, salt) with
    the salt taken from the row's file: a hot id is spread over `salts` tasks and reaches the second
    pass as at most `salts` rows per batch.
    """
    created = raw.select(
        "*",
        F.upper(F.trim(F.col("trip_id"))).alias("_id"),
        F.try_to_timestamp(F.col("event_created_at")).alias("_created"),
        F.pmod(F.xxhash64("file_name"), F.lit(salts)).alias("_salt"),
    )
    known = F.col("_id").isNotNull() & F.col("_created").isNotNull()
    extra = ("_id", "_created", "_salt")
    single = (
        created.filter(known)
        .withWatermark("_created", delay)
        .dropDuplicatesWithinWatermark(["_id", "_salt"])
        .dropDuplicatesWithinWatermark(["_id"])
        .drop(*extra)
    )
    return single.unionByName(created.filter(~known).drop(*extra))
