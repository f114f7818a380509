"""The micro-batch sink: one row of each trip in the fact table.

A micro-batch becomes the partitions `trip_date=<date>/load_batch=<stream>-<batch>`. Writing
replaces exactly those, so a batch that Spark replays after a failure replaces itself. Of a trip's
versions the latest counts, in whatever batches they come: a version that is not later than the
stored one is left out, and a later one is written beside it. The dates on which that happened are
noted before anything is written; readers of the fact (`FactTable`) take the latest version there and
read all other dates as they are. Nothing stored is rewritten or deleted, and no failure in between
shows a trip twice.

The look-up of stored trips and the write are not one transaction, so a fact has a single writer:
streams that share a fact must not run at the same time. The audit of the fact's trip ids
(`audit_fact`) finds what a second writer would repeat.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.operators.cleaning import DERIVED, normalise_trips
from tripmill.operators.lookup import BroadcastBudget
from tripmill.operators.survivors import (
    TRIP_PRECEDENCE,
    greatest_first,
    keyed,
    keyless,
    latest_trip,
    pick_survivor,
)
from tripmill.plans.fact_trip import enrich_trips
from tripmill.schemas import FACT_TRIP, TRIP_COLUMNS, TRIP_JSON
from tripmill.sources.files import CORRUPT
from tripmill.sources.tables import (
    ConnectorTable,
    PartitionedTable,
    date_texts,
)

log = logging.getLogger(__name__)

LOAD_BATCH = "load_batch"
TRIP_AND_DATE = ["trip_id", "trip_date"]
# Size of a (trip id, date) pair in a hash table beyond the text of the id.
KEY_OVERHEAD_BYTES = 64
STREAM_ID_PROPERTY = "sql.streaming.queryId"
# Which of two versions is later, across batches; a copy that only comes from another file is not.
VERSION = [name for name in TRIP_PRECEDENCE if name != "file_name"]


@dataclass(frozen=True)
class FactTable(PartitionedTable):
    """The fact as its readers see it: one row of each trip.

    Only dates that are noted to hold several versions of a trip cost a shuffle by trip id.
    """

    @property
    def versions(self) -> PartitionedTable:
        """Dates, as Spark's text, on which a load has written later versions of stored trips.

        `any_date` tells that the earlier versions may lie on other such dates.
        """
        schema = f"trip_date STRING, any_date BOOLEAN, {LOAD_BATCH} STRING"
        return PartitionedTable(f"{self.path}_versions", schema, (LOAD_BATCH,))

    def read(self, spark: SparkSession) -> DataFrame:
        return self._latest(super().read(spark), *self._noted(spark))

    def read_slices(self, spark: SparkSession, values: Iterable[str | None]) -> DataFrame | None:
        wanted = set(values)
        same, across = self._noted(spark)
        # A later version of a wanted date's trip may lie on another date.
        more = across if wanted & across else set()
        rows = super().read_slices(spark, wanted | more)
        return None if rows is None else self._latest(rows, same, across).filter(_on(wanted))

    def read_versions(self, spark: SparkSession, values: Iterable[str | None] | None = None):
        """Every stored version, of the given dates or of all."""
        return super().read(spark) if values is None else super().read_slices(spark, values)

    def _noted(self, spark: SparkSession) -> tuple[set[str | None], set[str | None]]:
        """The noted dates whose versions share their date, and those that may not: texts of dates."""
        noted = self.versions.read(spark).select("trip_date", "any_date").distinct().collect()
        across = {date for date, any_date in noted if any_date}
        return {date for date, _ in noted} - across, across

    def _latest(
        self, rows: DataFrame, same: set[str | None], across: set[str | None]
    ) -> DataFrame:
        parts = [rows.filter(~_on(same | across))] if same or across else [rows]
        for dates, key in ((same, ["trip_id", "trip_date"]), (across, ["trip_id"])):
            if dates:
                order = [*greatest_first(VERSION), F.col(LOAD_BATCH).asc()]
                parts.append(pick_survivor(rows.filter(_on(dates)), key, order))
        return reduce(DataFrame.unionByName, parts)


def _on(dates: set[str | None]) -> Column:
    """Whether a trip's date is among some, given as Spark's texts; prunes partitions."""
    text = F.col("trip_date").cast("string")
    known = F.coalesce(text.isin(sorted(d for d in dates if d is not None)), F.lit(False))
    return known | text.isNull() if None in dates else known


def fact_table(path: str) -> FactTable:
    return FactTable(path, f"{FACT_TRIP}, {LOAD_BATCH} STRING", ("trip_date", LOAD_BATCH))


def load_table(fact: PartitionedTable) -> PartitionedTable:
    """What each load changed: a row for each date, under an id of the attempt that wrote it.

    Dates are Spark's text of them, null for trips without one. A replayed load replaces its rows,
    and its new attempt tells readers that the dates hold something new.
    """
    schema = f"trip_date STRING, attempt STRING, {LOAD_BATCH} STRING"
    return PartitionedTable(f"{fact.path}_loads", schema, (LOAD_BATCH,))


def quarantine_table(path: str) -> PartitionedTable:
    """Raw rows without a trip id, with the unparsed line where there was one."""
    schema = f"{TRIP_JSON}, {CORRUPT} STRING, file_name STRING, {LOAD_BATCH} STRING"
    return PartitionedTable(path, schema, (LOAD_BATCH,))


@dataclass(frozen=True)
class TripSink:
    """`foreachBatch` function that turns raw trip rows into fact rows.

    `stations` opens the dimension; it is called for every batch, so a refreshed dimension takes
    effect with the next batch. Stored versions are looked up under the dates of the batch, which
    assumes that a re-sent trip keeps its start date; with `match_dates=False` they are looked up
    in the whole fact, which scans every written id for each batch. `stream_id` separates the
    batches of streams that share the tables; by default it is the id Spark keeps in the stream's
    checkpoint.
    """

    fact: FactTable
    quarantine: PartitionedTable
    stations: Callable[[SparkSession], DataFrame]
    budget: BroadcastBudget = BroadcastBudget()
    skip_known: bool = True
    match_dates: bool = True
    stream_id: str | None = None
    preview_rows: int = 0

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        load_batch = f"{self.stream_id or running_stream_id(spark)}-{batch_id}"
        # The batch is used for its statistics, the look-up and the writes; parse files once.
        # Lineage is kept, so a lost executor's blocks are recomputed.
        trips = parsed_once(raw)
        try:
            self._load(spark, trips, load_batch)
        finally:
            trips.unpersist()

    def _load(self, spark: SparkSession, batch_trips: DataFrame, load_batch: str) -> None:
        trips = batch_trips.drop("_raw")
        batch = BatchProfile.of(trips)
        if batch.rows == 0:
            log.info("load %s is empty, nothing written", load_batch)
            return
        new = latest_trip(keyed(trips))
        stored = self._stored_versions(spark, trips, batch, load_batch) if self.skip_known else None
        met = None
        if stored is not None:
            # The note and the write need the same comparison; it leaves out what is stored already.
            met = self._compare(new, stored).persist(StorageLevel.MEMORY_AND_DISK)
            new = met.filter("_is_new").select(*new.columns)
        try:
            changed = set(batch.dates)
            if met is not None:
                both = F.explode(F.array("trip_date", "_stored_date")).alias("trip_date")
                changed |= self._note(spark, met.filter("_is_later").select(both), load_batch)
            facts = enrich_trips(
                new, self.stations(spark), self.budget, visits=trips, write_by=["trip_date"]
            )
            self.fact.replace_partitions(facts.withColumn(LOAD_BATCH, F.lit(load_batch)))
            self._record(spark, changed, load_batch)
        finally:
            if met is not None:
                met.unpersist()
        if batch.without_id:
            lost = keyless(batch_trips).select("_raw.*").withColumn(LOAD_BATCH, F.lit(load_batch))
            self.quarantine.replace_partitions(lost)
        log.info("load %s: %d rows, %d without trip id", load_batch, batch.rows, batch.without_id)
        if self.preview_rows:
            written = self.fact.read(spark).filter(F.col(LOAD_BATCH) == load_batch)
            written.show(self.preview_rows, truncate=False)

    def _key(self) -> list[str]:
        return TRIP_AND_DATE if self.match_dates else TRIP_AND_DATE[:1]

    def _stored_versions(
        self, spark: SparkSession, trips: DataFrame, batch: BatchProfile, load_batch: str
    ) -> DataFrame | None:
        """Id, date, load and version of the batch's trips as other loads have written them.

        When the batch's ids are few enough to be broadcast, the fact is scanned but not shuffled.
        None if no other load has written there, as where a load meets only its own first attempt:
        then there is nothing to compare with, and the batch need not be kept beside it.
        """
        written = self.fact.read_versions(spark, batch.dates if self.match_dates else None)
        if written is None:
            return None
        written = written.filter(F.col(LOAD_BATCH) != load_batch)
        if written.isEmpty():
            return None
        others = written.select("trip_id", "trip_date", version().alias("version"))
        if batch.id_bytes > self.budget.limit_bytes:
            return others
        keys = keyed(trips).select(*self._key()).distinct()
        return _same_trip(others, F.broadcast(keys), self._key(), "left_semi")

    def _compare(self, new: DataFrame, stored: DataFrame) -> DataFrame:
        """The new rows, each beside every stored version of its trip (`_stored_date` is its date).

        `_is_later` holds where the stored version is beaten, and is null without any; `_is_new` in
        one row of each trip that is later than all of them. Rows with neither are left out.
        The new rows come out of their de-duplication partitioned and sorted by trip id. The join
        uses that, as its only key is the id and dates are compared beside it: of both sides
        only the stored one is shuffled.
        """
        left, right = new.alias("l"), stored.alias("r")
        on = F.col("l.trip_id") == F.col("r.trip_id")
        if self.match_dates:
            dates = F.col("l.trip_date"), F.col("r.trip_date")
            undated = dates[0].isNull() & dates[1].isNull()
            on &= F.coalesce(F.date_diff(*dates) == 0, undated)
        later = F.struct(*[F.col(f"l.{name}") for name in VERSION]) > F.col("r.version")
        met = left.join(right, on, "left").select(
            "l.*", F.col("r.trip_date").alias("_stored_date"), later.alias("_is_later")
        )
        # Where a stored version is not beaten, such a row comes first.
        first = F.row_number().over(Window.partitionBy("trip_id").orderBy("_is_later")) == 1
        met = met.withColumn("_is_new", first & F.coalesce("_is_later", F.lit(True)))
        return met.filter(F.col("_is_new") | F.col("_is_later"))

    def _note(self, spark: SparkSession, beaten: DataFrame, load_batch: str) -> set[str | None]:
        """Notes the dates that are about to hold several versions of a trip; returns them.

        A date too many costs its readers a shuffle and nothing else, so a failure after this is
        harmless, and a replay that finds less leaves the note of the first attempt.
        """
        dates = set(date_texts(beaten))
        if dates:
            rows = [(date, not self.match_dates, load_batch) for date in sorted(dates, key=str)]
            noted = spark.createDataFrame(rows, self.fact.versions.schema).coalesce(1)
            self.fact.versions.replace_partitions(noted)
        return dates

    def _record(self, spark: SparkSession, dates: set[str | None], load_batch: str) -> None:
        attempt = uuid.uuid4().hex
        rows = [(date, attempt, load_batch) for date in sorted(dates, key=str)]
        loads = load_table(self.fact)
        loads.replace_partitions(spark.createDataFrame(rows, loads.schema).coalesce(1))


def version() -> Column:
    """Comparable version of a trip: by creation time first, nulls least."""
    return F.struct(*[F.col(name) for name in VERSION])


@dataclass(frozen=True)
class BatchProfile:
    """Counts of a micro-batch, and its dates as Spark's text of them."""

    rows: int
    without_id: int
    id_bytes: int
    dates: list[str | None]

    @classmethod
    def of(cls, trips: DataFrame) -> BatchProfile:
        counts = [
            F.count("*"),
            F.count_if(F.col("trip_id").isNull()),
            F.coalesce(F.sum(F.octet_length("trip_id") + KEY_OVERHEAD_BYTES), F.lit(0)),
        ]
        text = F.col("trip_date").cast("string").alias("date")
        per_date = trips.groupBy(text).agg(*counts).collect()
        rows, without_id, id_bytes = (sum(line[i] for line in per_date) for i in (1, 2, 3))
        return cls(rows, without_id, id_bytes, [line[0] for line in per_date])


@dataclass(frozen=True)
class AppendSink:
    """Sink for tables that can only be appended to, such as those of a warehouse connector.

    Ids that are in the table already are left out, so copies in later batches and replays of a
    batch, in whole or in part, add nothing; the whole table's ids are scanned for each batch. As
    rows cannot be replaced, the first stored version of a trip stays. Quarantined rows have no id;
    a load that has any in the quarantine adds no more.
    """

    fact: ConnectorTable
    quarantine: ConnectorTable
    stations: Callable[[SparkSession], DataFrame]
    budget: BroadcastBudget = BroadcastBudget()
    stream_id: str | None = None
    preview_rows: int = 0

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        load_batch = f"{self.stream_id or running_stream_id(spark)}-{batch_id}"
        parsed = parsed_once(raw)
        try:
            if parsed.isEmpty():
                log.info("load %s is empty, nothing written", load_batch)
                return
            trips = parsed.drop("_raw")
            new = latest_trip(keyed(trips))
            if self.fact.exists(spark):
                known = self.fact.read(spark).select("trip_id")
                new = _same_trip(new, known, ["trip_id"], "left_anti")
            facts = enrich_trips(new, self.stations(spark), self.budget, visits=trips)
            self.fact.append(facts.withColumn(LOAD_BATCH, F.lit(load_batch)))
            lost = keyless(parsed).select("_raw.*").withColumn(LOAD_BATCH, F.lit(load_batch))
            if not lost.isEmpty() and not self._holds(spark, load_batch):
                self.quarantine.append(lost)
            if self.preview_rows:
                self.fact.read(spark).show(self.preview_rows, truncate=False)
        finally:
            parsed.unpersist()

    def _holds(self, spark: SparkSession, load_batch: str) -> bool:
        if not self.quarantine.exists(spark):
            return False
        same = F.col(LOAD_BATCH) == load_batch
        return not self.quarantine.read(spark).filter(same).isEmpty()


def running_stream_id(spark: SparkSession) -> str:
    """Id of the stream whose batch this thread runs; it survives restarts from a checkpoint."""
    stream_id = spark.sparkContext.getLocalProperty(STREAM_ID_PROPERTY)
    if stream_id is None:
        raise RuntimeError("not inside a streaming micro-batch: give the sink a stream_id")
    return stream_id


def with_corrupt(raw: DataFrame) -> DataFrame:
    present = set(raw.columns)
    extras = [
        F.col(name) if name in present else F.lit(None).cast("string").alias(name)
        for name in (CORRUPT, "file_name")
    ]
    return raw.select(*TRIP_COLUMNS, *extras)


def parsed_once(raw: DataFrame) -> DataFrame:
    """Normalised trips, kept in memory and on disk; `_raw` holds the row as it came.

    Only rows without a trip id are ever needed as they came, so `_raw` is null in all others.
    """
    raw = with_corrupt(raw)
    as_it_came = F.when(F.col("trip_id").isNull(), F.struct(*raw.columns))
    trips = normalise_trips(raw, as_it_came.alias("_raw"))
    # The facts get these from `enrich_trips`; a load itself uses the date alone.
    trips = trips.drop(*[name for name in DERIVED if name != "trip_date"])
    return trips.persist(StorageLevel.MEMORY_AND_DISK)


def _same_trip(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on the trip id, which is never null here, and on the date if it is in the key."""
    left, right = left.alias("l"), right.alias("r")
    on = [F.col("l.trip_id") == F.col("r.trip_id")]
    if "trip_date" in key:
        on.append(F.col("l.trip_date").eqNullSafe(F.col("r.trip_date")))
    return left.join(right, on, how)
