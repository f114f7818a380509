"""Event-time windows over the trip stream, with late trips set aside.

A micro-batch meets the watermark that earlier batches have left. Its trips are counted into the
windows that are still open, as partial sums stored under the batch; trips that a closed window has
missed go to a side table. A replayed batch replaces its own rows and meets the same watermark, so
nothing is counted twice and no trip changes sides. A window's row is the sum of its batches' partial
sums, and does not change any more once the watermark has passed its end.

Sessions have no windows known in advance; `bike_sessions` keeps them in Spark's watermarked state.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.numbers import hundredths
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.survivors import keyed, latest_trip
from tripmill.schemas import columns
from tripmill.sources.tables import PartitionedTable, rebalanced

BATCH = "batch_id"
# Length and step of each kind of window; a step shorter than the length makes windows overlap.
KINDS = {"hour": ("1 hour", "1 hour"), "quarter_day": ("6 hours", "1 hour")}
# What is counted or set aside of a trip; nothing else is kept of a batch.
COUNTED = ["trip_id", "bike_id", "bike_type", "start_time", "end_time", "trip_duration_minutes"]
PARTIAL = f"""
    kind STRING, window_start TIMESTAMP, window_end TIMESTAMP, bike_type STRING,
    trip_count BIGINT, duration BIGINT, {BATCH} BIGINT
"""
LATE = f"""
    trip_id STRING, bike_id STRING, bike_type STRING, start_time TIMESTAMP, end_time TIMESTAMP,
    missed BIGINT, {BATCH} BIGINT
"""


@dataclass(frozen=True)
class WindowSink:
    """`foreachBatch` function that counts raw trips by window of their start.

    `delay` is how long before the newest start of earlier batches a window closes. Trips without an
    id or a readable start are in no window and not late either. Of a trip's versions in one batch the
    latest counts; give the sink de-duplicated trips where versions come in several batches.
    """

    path: str
    delay: str = "1 day"
    kinds: Mapping[str, tuple[str, str]] = field(default_factory=lambda: dict(KINDS))

    @property
    def partials(self) -> PartitionedTable:
        return PartitionedTable(f"{self.path}/partials", PARTIAL, (BATCH,))

    @property
    def late(self) -> PartitionedTable:
        return PartitionedTable(f"{self.path}/late", LATE, (BATCH,))

    @property
    def progress(self) -> PartitionedTable:
        """The newest start of each batch: one row."""
        return PartitionedTable(f"{self.path}/progress", f"newest TIMESTAMP, {BATCH} BIGINT", (BATCH,))

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        trips = latest_trip(keyed(normalise_trips(raw))).filter("start_time is not null")
        trips = trips.select(*COUNTED).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            placed = self._placed(trips)
            closed = F.col("w.end") <= self.watermark(spark, before=batch_id)
            closed = F.coalesce(closed, F.lit(False))
            self._put(self.late, self._missed(placed.filter(closed)), batch_id)
            self._put(self.partials, self._counted(placed.filter(~closed)), batch_id)
            newest = trips.agg(F.max("start_time").alias("newest"))
            self._put(self.progress, newest.filter("newest is not null"), batch_id)
        finally:
            trips.unpersist()

    def watermark(self, spark: SparkSession, before: int | None = None) -> Column:
        """The newest start of the batches before one, or of all, less the delay; null without any.

        Batches come in the order of their ids, so a replayed batch finds what it found the first time.
        """
        progress = self.progress.read(spark)
        if before is not None:
            progress = progress.filter(F.col(BATCH) < before)
        # As a number, since Python knows fewer years than Spark.
        newest = progress.agg(F.unix_micros(F.max("newest"))).first()[0]
        return F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {self.delay}")

    def _placed(self, trips: DataFrame) -> DataFrame:
        """The trips once for each window that their start is in."""
        parts = [
            trips.select("*", F.lit(kind).alias("kind"), F.window("start_time", *spans).alias("w"))
            for kind, spans in self.kinds.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def _missed(self, placed: DataFrame) -> DataFrame:
        """Trips with the number of closed windows they came too late for."""
        names = ["trip_id", "bike_id", "bike_type", "start_time", "end_time"]
        return placed.groupBy(*names).agg(F.count("*").alias("missed"))

    def _counted(self, placed: DataFrame) -> DataFrame:
        start, end = F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")
        return placed.groupBy("kind", start, end, "bike_type").agg(
            F.count("*").alias("trip_count"),
            F.sum(hundredths(F.col("trip_duration_minutes"))).alias("duration"),
        )

    def _put(self, table: PartitionedTable, rows: DataFrame, batch_id: int) -> None:
        """A batch's rows in place of what an earlier attempt has left of it."""
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long")).select(*columns(table.schema))
        table.replace_partitions(rebalanced(rows, BATCH))

    def windows(self, spark: SparkSession) -> DataFrame:
        """(kind, window_start, window_end, bike_type, trip_count, minutes, is_closed)."""
        closed = F.coalesce(F.col("window_end") <= self.watermark(spark), F.lit(False))
        totals = self.partials.read(spark).groupBy(
            "kind", "window_start", "window_end", "bike_type"
        ).agg(F.sum("trip_count").alias("trip_count"), F.sum("duration").alias("duration"))
        return totals.select(
            "kind",
            "window_start",
            "window_end",
            "bike_type",
            "trip_count",
            (F.col("duration") / F.lit(100.0)).alias("minutes"),
            closed.alias("is_closed"),
        )


def bike_sessions(trips: DataFrame, gap: str = "4 hours", delay: str = "1 day") -> DataFrame:
    """Runs of starts of a bike with at most `gap` between them, from a stream or a table of trips.

    (bike_id, session_start, session_end, trip_count); a session ends `gap` after its last start. In a
    stream a session comes out once, when the watermark has passed its end, and trips later than
    that are dropped.
    """
    started = trips.filter("bike_id is not null and start_time is not null")
    if started.isStreaming:
        started = started.withWatermark("start_time", delay)
    sessions = started.groupBy(F.session_window("start_time", gap).alias("s"), "bike_id").agg(
        F.count("*").alias("trip_count")
    )
    return sessions.select(
        "bike_id",
        F.col("s.start").alias("session_start"),
        F.col("s.end").alias("session_end"),
        "trip_count",
    )
