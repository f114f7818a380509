"""Departures and arrivals as two streams, joined to trips.

Each side is watermarked and keeps its events only as long as a partner can still come: an arrival is
at most `longest` after its departure. A departure whose time is up without one comes out as a trip
that never ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.cleaning import normalise_trips
from tripmill.sources.tables import PartitionedTable, rebalanced

BATCH = "batch_id"
PAIRED = f"""
    trip_id STRING, bike_id STRING, start_station_id STRING, start_time TIMESTAMP,
    end_station_id STRING, end_time TIMESTAMP, status STRING, {BATCH} BIGINT
"""


def paired_trips(
    departures: DataFrame, arrivals: DataFrame, longest: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """(trip_id, bike_id, start_station_id, start_time, end_station_id, end_time, status).

    Both sides are raw trip rows, of which departures give the start and arrivals the end. `status` is
    `ended`, `open` (no arrival between the start and `longest` after it) or `unusable` for departures
    without an id or a readable start, which never wait for anything. Copies of an event that come
    within the delay of each other count once; events later than the delay are dropped. Streams and
    tables give the same rows, but for what comes late.
    """
    left = normalise_trips(departures).select("trip_id", "bike_id", "start_station_id", "start_time")
    right = normalise_trips(arrivals).select(
        F.col("trip_id").alias("_id"), "end_station_id", "end_time"
    )
    usable = F.col("trip_id").isNotNull() & F.col("start_time").isNotNull()
    right = right.filter(F.col("_id").isNotNull() & F.col("end_time").isNotNull())
    begun = _once(left.filter(usable), "trip_id", "start_time", delay)
    over = _once(right, "_id", "end_time", delay)
    limit = F.col("start_time") + F.expr(f"INTERVAL {longest}")
    partner = (
        (F.col("trip_id") == F.col("_id"))
        & (F.col("end_time") >= F.col("start_time"))
        & (F.col("end_time") <= limit)
    )
    status = F.when(F.col("_id").isNotNull(), "ended").otherwise("open")
    joined = begun.join(over, partner, "left_outer").withColumn("status", status).drop("_id")
    rest = left.filter(~usable).select(
        "*",
        F.lit(None).cast("string").alias("end_station_id"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.lit("unusable").alias("status"),
    )
    return joined.unionByName(rest)


def _once(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def paired_table(path: str) -> PartitionedTable:
    return PartitionedTable(path, PAIRED, (BATCH,))


def by_batch(table: PartitionedTable) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that stores a batch's rows under its id; a replay replaces them."""

    def store(rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
        table.replace_partitions(rebalanced(rows, BATCH))

    return store
