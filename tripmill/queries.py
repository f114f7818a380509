"""Every table, mart, report, audit and stream of the library over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import fixtures
from tripmill.operators.checks import audit_history, non_null_audit, unique_audit
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.lookup import BroadcastBudget, active_station_lookup, station_role
from tripmill.operators.nearby import nearest_within
from tripmill.operators.survivors import keyed, latest_trip
from tripmill.operators.validity import reject_reasons
from tripmill.plans import cubes, marts, movements, questions, sketches
from tripmill.plans.dim_station import (
    build_dim_station,
    load_dim_station,
    preview,
    station_rejects,
)
from tripmill.plans.fact_trip import build_fact_trip, enrich_trips
from tripmill.plans.reconciliation import reconciliation
from tripmill.plans.refresh import (
    AuditFailed,
    audit_fact,
    build_marts,
    partitioned_marts,
    refresh_logs,
    refresh_touched_dates,
)
from tripmill.session import pin_utc
from tripmill.sources.files import land_trips, read_trip_json, stream_trip_json
from tripmill.sources.tables import (
    ConnectorTable,
    PartitionedTable,
    SnapshotTable,
    declare,
    rebalanced,
)
from tripmill.sources.workdir import new_workdir
from tripmill.streaming.job import drain_trip_stream, start_trip_stream
from tripmill.streaming.pairing import by_batch, paired_table, paired_trips
from tripmill.streaming.sink import (
    LOAD_BATCH,
    AppendSink,
    TripSink,
    fact_table,
    quarantine_table,
)
from tripmill.streaming.windows import WindowSink, bike_sessions

Query = Callable[[SparkSession, str], DataFrame]

# Load time and file path differ from run to run.
RUN_COLUMNS = ("load_dt", "mart_load_dt", "run_dt", "file_name", "load_batch")


def comparable(df: DataFrame) -> DataFrame:
    """Without run-dependent columns; instants as UTC wall-clock values without a zone."""
    return df.select(
        *[
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in df.schema.fields
            if field.name not in RUN_COLUMNS
        ]
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_station(fixtures.raw_stations(spark, sf_dir))


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_trips(fixtures.raw_trips(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of all trips; the trip ids of the plain mapping are unique already."""
    budget = fixtures.station_budget(spark, sf_dir)
    return enrich_trips(normalised(spark, sf_dir), dim(spark, sf_dir), budget)


def large_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    budget = fixtures.station_budget(spark, sf_dir)
    return build_fact_trip(fixtures.raw_trips_large(spark, sf_dir), dim(spark, sf_dir), budget)


def lookup_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The active lookup in both roles, stacked."""
    lookup = active_station_lookup(dim(spark, sf_dir))
    roles = [
        station_role(lookup, role).toDF(
            "station_id", "station_name", "neighbourhood", "capacity", "known"
        ).withColumn("role", F.lit(role))
        for role in ("start", "end")
    ]
    return roles[0].unionByName(roles[1])


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    resent = fixtures.raw_trips(spark, sf_dir, resent="later")
    return latest_trip(keyed(normalise_trips(resent)))


def deduplicated_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_trip(keyed(normalise_trips(fixtures.raw_trips_large(spark, sf_dir))))


# Queries that write tables work in a directory of their own.


def stream_sink(spark: SparkSession, sf_dir: str, workdir: str) -> TripSink:
    stations = SnapshotTable(f"{workdir}/dim_station")
    stations.replace(dim(spark, sf_dir))
    return TripSink(
        fact_table(f"{workdir}/fact_trip"),
        quarantine_table(f"{workdir}/fact_trip_quarantine"),
        stations.read,
        fixtures.station_budget(spark, sf_dir),
    )


def streamed(spark: SparkSession, sf_dir: str) -> TripSink:
    workdir = new_workdir(spark, "fact_trip_stream")
    sink = stream_sink(spark, sf_dir, workdir)
    land_trips(fixtures.raw_trips(spark, sf_dir), f"{workdir}/landing")
    drain_trip_stream(spark, f"{workdir}/landing", f"{workdir}/checkpoint", sink)
    return sink


def fact_trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).fact.read(spark)


def trip_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).quarantine.read(spark).drop("_corrupt_record")


def stream_cross_batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips land and load; then they land again with exact copies, and a restart loads that."""
    workdir = new_workdir(spark, "stream_cross_batch_dedupe")
    sink = stream_sink(spark, sf_dir, workdir)
    landing, checkpoint = f"{workdir}/landing", f"{workdir}/checkpoint"
    for resent in (None, "exact"):
        land_trips(fixtures.raw_trips(spark, sf_dir, resent), landing)
        drain_trip_stream(spark, landing, checkpoint, sink)
    return sink.fact.read(spark)


def stream_batch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One micro-batch delivered twice under the same batch id."""
    workdir = new_workdir(spark, "stream_batch_replay")
    sink = stream_sink(spark, sf_dir, workdir)
    sink = TripSink(sink.fact, sink.quarantine, sink.stations, sink.budget, stream_id="replay")
    batch = fixtures.raw_trips(spark, sf_dir, resent="later")
    for _ in range(2):
        sink(batch, 0)
    return sink.fact.read(spark)


def stream_cross_batch_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of the re-sent trips, in two landings and several batches each.

    Of half of the trips the later version lands first.
    """
    workdir = new_workdir(spark, "stream_cross_batch_versions")
    sink = stream_sink(spark, sf_dir, workdir)
    sent = fixtures.raw_trips(spark, sf_dir, resent="later")
    later = F.col("user_type") == "MEMBER"
    first = later == (F.crc32(F.coalesce("trip_id", F.lit(""))) % 2 == 0)
    landing, checkpoint = f"{workdir}/landing", f"{workdir}/checkpoint"
    for part, max_files in ((sent.filter(first), 20), (sent.filter(~first), 1000)):
        land_trips(part, landing)
        drain_trip_stream(spark, landing, checkpoint, sink, max_files=max_files)
    return sink.fact.read(spark)


def fact_trip_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in one batch from landed files of all dates."""
    landing = f"{new_workdir(spark, 'fact_trip_from_files')}/landing"
    land_trips(fixtures.raw_trips(spark, sf_dir), landing)
    raw = read_trip_json(spark, landing, ingest_from="2024-01-01")
    return build_fact_trip(raw, dim(spark, sf_dir), fixtures.station_budget(spark, sf_dir))


def connector_at(path: str) -> ConnectorTable:
    return ConnectorTable(format="parquet", options={"path": path})


def stream_append_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, its replay and a batch of copies through the sink of append-only tables."""
    workdir = new_workdir(spark, "stream_append_replay")
    trips = stream_sink(spark, sf_dir, workdir)
    sink = AppendSink(
        connector_at(f"{workdir}/appended"),
        connector_at(f"{workdir}/appended_quarantine"),
        trips.stations,
        trips.budget,
        stream_id="append",
    )
    for batch_id in (0, 0, 1):
        sink(fixtures.raw_trips(spark, sf_dir), batch_id)
    return sink.fact.read(spark)


def stream_odd_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Far years, unreadable times, malformed lines, missing ids and odd file names, counted.

    Loaded with the look-up of stored trips, and again with de-duplication in the stream.
    """
    workdir = new_workdir(spark, "stream_odd_landing")
    landing = f"{workdir}/landing"
    land_trips(fixtures.odd_trips(spark, sf_dir), landing)
    lines = fixtures.malformed_lines(spark, sf_dir)
    lines.write.mode("append").text(f"{landing}/ingest_date=2024-01-01")
    counts = []
    for name, options in (("", {}), ("watermark_", {"watermark_delay": "400 days"})):
        sink = stream_sink(spark, sf_dir, f"{workdir}/{name}tables")
        drain_trip_stream(spark, landing, f"{workdir}/{name}checkpoint", sink, **options)
        fact = sink.fact.read(spark)
        parts = {f"{name}fact": fact, f"{name}quarantine": sink.quarantine.read(spark)}
        if not name:
            parts["fact_far_years"] = fact.filter("year(trip_date) not between 1 and 9999")
        counts += [
            df.agg(F.lit(part).alias("part"), F.count("*").alias("part_rows"))
            for part, df in parts.items()
        ]
    return reduce(DataFrame.unionByName, counts)


def two_loads(spark: SparkSession, sf_dir: str, workdir: str) -> tuple[TripSink, list[DataFrame]]:
    """A sink and two loads for it.

    The second load brings the last ten days and late evenings of the ten days before.
    """
    sink = stream_sink(spark, sf_dir, workdir)
    sink = TripSink(sink.fact, sink.quarantine, sink.stations, sink.budget, stream_id="load")
    raw = fixtures.raw_trips(spark, sf_dir)
    evening = F.substring("start_time", 12, 2) >= "18"
    second = (F.col("start_time") >= "2024-01-21") | (
        (F.col("start_time") >= "2024-01-11") & evening
    )
    return sink, [raw.filter(~second), raw.filter(second)]


def mart_incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, each followed by a refresh of the dates it touched."""
    workdir = new_workdir(spark, "mart_incremental_refresh")
    sink, loads = two_loads(spark, sf_dir, workdir)
    log_of, target_of = refresh_logs(f"{workdir}/gold"), partitioned_marts(f"{workdir}/gold")
    for batch_id, load in enumerate(loads):
        sink(load, batch_id)
        refresh_touched_dates(spark, sink.fact, log_of, target_of, tags=("demand",))
    return target_of(marts.MARTS["mart_hourly_demand"]).read(spark)


def mart_refresh_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tag after the first load, all after the second and after its replay."""
    workdir = new_workdir(spark, "mart_refresh_by_tag")
    sink, (first, second) = two_loads(spark, sf_dir, workdir)
    log_of, target_of = refresh_logs(f"{workdir}/gold"), partitioned_marts(f"{workdir}/gold")
    steps = ((first, 0, "demand"), (second, 1, "gold"), (second, 1, "gold"))
    for load, batch_id, tag in steps:
        sink(load, batch_id)
        refresh_touched_dates(spark, sink.fact, log_of, target_of, tags=(tag,))
    return target_of(marts.MARTS["mart_station_daily_activity"]).read(spark)


def fact_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads and a replay of the first, published as a snapshot by date without versions."""
    workdir = new_workdir(spark, "fact_compacted")
    sink, loads = two_loads(spark, sf_dir, workdir)
    for batch_id, load in enumerate([*loads, loads[0]]):
        sink(load, batch_id % 2)
    snapshot = SnapshotTable(f"{workdir}/fact_snapshot", ("trip_date",))
    snapshot.replace(rebalanced(sink.fact.read(spark), "trip_date"))
    return snapshot.read(spark)


def audit_fact_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink, loads = two_loads(spark, sf_dir, new_workdir(spark, "audit_fact_unique"))
    for batch_id, load in enumerate([*loads, loads[0]]):
        sink(load, batch_id)
    return audit_fact(sink.fact.read(spark))


def fact_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose source file, load and load time are what a load writes."""
    formed = {
        "file_name": F.col("file_name").like("%/ingest_date=%/part-%"),
        LOAD_BATCH: F.col(LOAD_BATCH).rlike("^[0-9a-f-]{36}-[0-9]+$"),
        "load_dt": F.col("load_dt") <= F.current_timestamp(),
    }
    counts = streamed(spark, sf_dir).fact.read(spark).agg(
        F.array(
            *[
                F.struct(F.lit(n).alias("column_name"), F.count_if(c).alias("well_formed"))
                for n, c in formed.items()
            ]
        ).alias("lines")
    )
    return counts.select(F.inline("lines"))


def station_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations written as CSV, loaded with the counted guards, and read back."""
    workdir = new_workdir(spark, "station_csv_load")
    raw = fixtures.raw_stations(spark, sf_dir)
    kept_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, **kept_spaces).csv(f"{workdir}/stations")
    target = SnapshotTable(f"{workdir}/dim_station")
    load_dim_station(spark, f"{workdir}/stations", target)
    return target.read(spark)


def station_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(station_csv_load(spark, sf_dir))


def station_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dimension load says to a file of stations, to one without rows, and to one without ids.

    A refused load leaves the dimension as it was.
    """
    workdir = new_workdir(spark, "station_guards")
    raw = fixtures.raw_stations(spark, sf_dir)
    target = SnapshotTable(f"{workdir}/dim_station")
    blank = raw.withColumn("station_id", F.lit("  "))
    kept_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines = []
    for case, rows in (("stations", raw), ("no_rows", raw.filter("false")), ("no_ids", blank)):
        path = f"{workdir}/{case}"
        rows.coalesce(1).write.options(header=True, **kept_spaces).csv(path)
        try:
            load_dim_station(spark, path, target)
            outcome = "loaded"
        except ValueError:
            outcome = "refused"
        count = target.read(spark).agg(F.count("*").alias("stations"))
        lines.append(count.select(F.lit(case).alias("load"), F.lit(outcome).alias("outcome"), "stations"))
    return reduce(DataFrame.unionByName, lines)


def stream_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that runs until it is stopped; half of the trips land while it runs."""
    workdir = new_workdir(spark, "stream_periodic")
    sink = stream_sink(spark, sf_dir, workdir)
    raw, later = fixtures.raw_trips(spark, sf_dir), F.col("start_time") >= "2024-01-16"
    land_trips(raw.filter(~later), f"{workdir}/landing")
    query = start_trip_stream(
        spark, f"{workdir}/landing", f"{workdir}/checkpoint", sink, processing_time="500 milliseconds"
    )
    try:
        query.processAllAvailable()
        land_trips(raw.filter(later), f"{workdir}/landing")
        query.processAllAvailable()
    finally:
        query.stop()
    return sink.fact.read(spark)


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads with rows, counted: an empty batch between two others leaves none."""
    sink, (first, second) = two_loads(spark, sf_dir, new_workdir(spark, "stream_empty_batch"))
    for batch_id, load in enumerate((first, first.filter("false"), second)):
        sink(load, batch_id)
    return sink.fact.read(spark).groupBy(F.col(LOAD_BATCH).alias("load")).agg(
        F.count("*").alias("trip_rows")
    )


def stream_watermark_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of trips in two landings, de-duplicated in the stream: the first to land stays."""
    workdir = new_workdir(spark, "stream_watermark_versions")
    sink = stream_sink(spark, sf_dir, workdir)
    sent = fixtures.raw_trips(spark, sf_dir, resent="later")
    number = F.coalesce(F.regexp_extract("trip_id", "([0-9]+)", 1).try_cast("long"), F.lit(0))
    first = (F.col("user_type") == "MEMBER") == (number % 40 == 0)
    kept = {
        "watermark_delay": "400 days",
        "state_partitions": fixtures.build_tasks(spark, fixtures.table(spark, sf_dir, "events")),
    }
    for part in (first, ~first):
        land_trips(sent.filter(part), f"{workdir}/landing")
        drain_trip_stream(spark, f"{workdir}/landing", f"{workdir}/checkpoint", sink, **kept)
    return sink.fact.read(spark).select("trip_id", "user_type", "event_created_at")


def mart_load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each mart whose load time is the one of its own build."""
    facts = stored_fact(spark, sf_dir, "mart_load_times")
    target_of = partitioned_marts(f"{new_workdir(spark, 'mart_load_times')}/gold")
    started = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    build_marts(facts, target_of)
    now = F.unix_micros("mart_load_dt")
    counts = [
        target_of(mart).read(spark).agg(
            F.lit(name).alias("mart"),
            F.count_if((now >= started) & (now <= F.unix_micros(F.current_timestamp()))).alias("timed"),
        )
        for name, mart in marts.MARTS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stored_fact(
    spark: SparkSession, sf_dir: str, purpose: str, columns: tuple[str, ...] = ()
) -> DataFrame:
    """The fact of all trips, stored: what marts that read it twice are built from.

    With `columns`, what a caller needs of it.
    """
    fact = SnapshotTable(f"{new_workdir(spark, purpose)}/fact_trip", ("trip_date",))
    rows = enriched(spark, sf_dir)
    fact.replace(rows.select("trip_date", *columns) if columns else rows)
    return fact.read(spark)


# What the daily activity of stations reads of the fact.
ACTIVITY = (
    "is_valid_trip",
    "trip_duration_minutes",
    *[f"{r}_{c}" for r in ("start", "end") for c in ("station_id", "station_name", "neighbourhood")],
)


def build_marts_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts tagged `station`, built from the declared fact and counted."""
    target_of = partitioned_marts(f"{new_workdir(spark, 'build_marts_by_tag')}/gold")
    declare(spark, "fact_trip", stored_fact(spark, sf_dir, "build_marts_by_tag"))
    build_marts(spark.table("fact_trip"), target_of, tags=("station",))
    counts = [
        target_of(mart).read(spark).agg(
            F.lit(mart.name).alias("mart"), F.count("*").alias("mart_rows")
        )
        for mart in marts.marts_tagged(("station",))
    ]
    return counts[0].unionByName(counts[1])


def audit_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit lines that a refresh has appended to the audit table."""
    workdir = new_workdir(spark, "audit_store")
    target = connector_at(f"{workdir}/audit")
    facts = stored_fact(spark, sf_dir, "audit_store")
    build_marts(facts, partitioned_marts(f"{workdir}/gold"), ("station",), target)
    return target.read(spark)


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of the audits of two builds, the second of a fact in which some dates are lost."""
    workdir = new_workdir(spark, "audit_runs")
    target = connector_at(f"{workdir}/audit")
    whole = stored_fact(spark, sf_dir, "audit_runs", (*ACTIVITY, "bike_type", "user_type"))
    early = F.col("trip_date") < F.lit("2024-01-04").cast("date")
    broken = whole.withColumn("trip_date", F.when(~early, F.col("trip_date")))
    for facts in (whole, broken):
        try:
            build_marts(facts, partitioned_marts(f"{workdir}/gold"), ("od",), target)
        except AuditFailed:
            # The mart keeps its rows; the lines are stored.
            continue
    history = audit_history(target.read(spark))
    return history.select("check_name", "column_name", "runs", "failed_runs", "last_violations")


def large_fact_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large fact with a lookup that is beyond the broadcast budget."""
    budget = BroadcastBudget(limit_bytes=0, known_bytes=1, hot_share=1 / 64)
    return build_fact_trip(fixtures.raw_trips_large(spark, sf_dir), dim(spark, sf_dir), budget)


def from_fact(build: Callable[[DataFrame], DataFrame], fact: Query = enriched) -> Query:
    return lambda spark, sf_dir: build(fact(spark, sf_dir))


def daily_of_computed(facts: DataFrame) -> DataFrame:
    """These queries compute the fact from raw rows, which is worth doing once."""
    return marts.station_daily_activity(facts, single_scan=True)


def from_stored(build: Callable[[DataFrame], DataFrame], purpose: str) -> Query:
    """A query of the daily activity, which reads the fact twice."""
    return lambda spark, sf_dir: build(stored_fact(spark, sf_dir, purpose, ACTIVITY))


def as_of_query(budget: BroadcastBudget) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        versions = movements.station_versions(fixtures.raw_station_versions(spark, sf_dir))
        trips = normalised(spark, sf_dir).select(
            "trip_id", "start_station_id", "end_station_id", "start_time", "end_time"
        )
        return movements.trips_as_of(trips, versions, budget)

    return query


def trip_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = enriched(spark, sf_dir)
    return movements.trips_in_closures(facts, fixtures.station_closures(spark, sf_dir))


def stored_sketches(spark: SparkSession, sf_dir: str, purpose: str) -> DataFrame:
    """Sketches of two loads of trips, by load; the second is written twice."""
    table = sketches.sketch_table(f"{new_workdir(spark, purpose)}/sketches")
    facts = enriched(spark, sf_dir)
    second = F.col("trip_date") >= F.lit("2024-01-16").cast("date")
    for load, part in (("1", facts.filter(~second)), ("2", facts.filter(second))) * 2:
        sketches.add_load(table, part, load)
    return table.read(spark)


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct bikes and users by neighbourhood over all dates, from sketches by hour."""
    stored = stored_sketches(spark, sf_dir, "distinct_sketches")
    found = sketches.estimated(sketches.merged(stored, ["start_neighbourhood"]))
    return found.drop("duration_quantiles")


def duration_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the durations by bike type from merged sketches, with the ranks they really have.

    A quantile is right if its rank is at most three hundredths away from the one that was asked for.
    """
    stored = stored_sketches(spark, sf_dir, "duration_sketches")
    asked = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = sketches.estimated(sketches.merged(stored, ["bike_type"]), asked)
    values = found.select("bike_type", "trip_count", F.posexplode("duration_quantiles"))
    trips = enriched(spark, sf_dir).filter("is_valid_trip").select(
        F.col("bike_type").alias("type"), "trip_duration_minutes"
    )
    met = trips.join(values, F.col("type").eqNullSafe(F.col("bike_type")))
    ranks = met.groupBy("bike_type", "trip_count", "pos", "col").agg(
        (F.count_if(F.col("trip_duration_minutes") < F.col("col")) / F.count("*")).alias("below"),
        (F.count_if(F.col("trip_duration_minutes") <= F.col("col")) / F.count("*")).alias("upto"),
    )
    rank = F.element_at(F.array(*[F.lit(a) for a in asked]), F.col("pos") + 1)
    exact = F.when(F.col("pos").isin(0, len(asked) - 1), F.col("col"))
    close = (F.col("below") - 0.03 <= rank) & (rank <= F.col("upto") + 0.03)
    return ranks.select(
        "bike_type", "trip_count", rank.alias("rank"), exact.alias("bound"), close.alias("is_close")
    )


def returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_sketches(spark, sf_dir, "returning_users")
    return sketches.returning(stored, "users", "2024-01-03", "2024-01-28")


def some_grouping_sets(facts: DataFrame) -> DataFrame:
    sets = [["trip_date"], ["start_neighbourhood", "bike_type"], []]
    names = ["trip_date", "start_neighbourhood", "bike_type"]
    return cubes.demand_grouping_sets(facts, sets, names)


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in two versions, loaded in two batches of which one comes twice, against what is stored."""
    workdir = new_workdir(spark, "load_reconciliation")
    sink = stream_sink(spark, sf_dir, workdir)
    sink = TripSink(sink.fact, sink.quarantine, sink.stations, sink.budget, stream_id="load")
    sent = fixtures.raw_trips(spark, sf_dir, resent="later")
    later = F.col("user_type") == "MEMBER"
    first = later == (F.crc32(F.coalesce("trip_id", F.lit(""))) % 2 == 0)
    for batch_id, part in ((0, first), (1, ~first), (1, ~first)):
        sink(sent.filter(part), batch_id)
    quarantine = normalise_trips(sink.quarantine.read(spark))
    return reconciliation(normalise_trips(sent), sink.fact.read(spark), quarantine)


def nearest_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each station's nearest other active station within a kilometre and a half."""
    stations = dim(spark, sf_dir)
    active = stations.filter("is_active")
    found = nearest_within(stations, active, "station_id", "station_id", 1500.0)
    return found.withColumn("metres", F.rint("metres").cast("long"))


def windowed(spark: SparkSession, sf_dir: str, purpose: str) -> WindowSink:
    """Trips in three batches, the second delivered twice; the third brings some of the first days."""
    sink = WindowSink(new_workdir(spark, purpose))
    raw = fixtures.raw_trips(spark, sf_dir)
    number = F.coalesce(F.regexp_extract("trip_id", "([0-9]+)", 1).try_cast("long"), F.lit(0))
    held = (number % 50 == 1) & (F.col("start_time") < "2024-01-25")
    first = F.col("start_time") < "2024-01-21"
    for batch_id, part in ((0, first & ~held), (1, ~first & ~held), (1, ~first & ~held), (2, held)):
        sink(raw.filter(part), batch_id)
    return sink


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(spark, sf_dir, "stream_windows").windows(spark)


def stream_late_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(spark, sf_dir, "stream_late_trips").late.read(spark).drop("batch_id")


def far_trips(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """One trip of a far day, which moves a stream's watermark past all others."""
    trip = fixtures.raw_trips(spark, sf_dir).filter("trip_id is not null").limit(1)
    moved = {c: F.lit(f"{day}T00:00:00+00:00") for c in ("start_time", "end_time", "event_created_at")}
    return trip.withColumns({**moved, "trip_id": F.lit("far"), "bike_id": F.lit("far")})


def stream_bike_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of bikes from a stream in two runs, the second with a far trip that closes them all."""
    workdir = new_workdir(spark, "stream_bike_sessions")
    raw, later = fixtures.raw_trips(spark, sf_dir), F.col("start_time") >= "2024-01-16"
    target = PartitionedTable(f"{workdir}/sessions", SESSIONS, ("batch_id",))
    far = far_trips(spark, sf_dir, "2030-01-01")
    for part in (raw.filter(~later), raw.filter(later), far):
        land_trips(part, f"{workdir}/landing")
        sessions = bike_sessions(normalise_trips(stream_trip_json(spark, f"{workdir}/landing")))
        drained(sessions, target, f"{workdir}/checkpoint")
    return target.read(spark).drop("batch_id")


SESSIONS = """
    bike_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, trip_count BIGINT, batch_id BIGINT
"""


def stream_paired_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures and arrivals landed apart and joined as streams, in three runs."""
    workdir = new_workdir(spark, "stream_paired_trips")
    raw, later = fixtures.raw_trips(spark, sf_dir), F.col("start_time") >= "2024-01-16"
    target = paired_table(f"{workdir}/paired")
    far = far_trips(spark, sf_dir, "2030-01-01")
    for part in (raw.filter(~later), raw.filter(later), far):
        for side, other in (("departures", "end"), ("arrivals", "start")):
            gone = {f"{other}_{c}": F.lit(None).cast("string") for c in ("station_id", "time")}
            land_trips(part.withColumns(gone), f"{workdir}/{side}")
        sides = [stream_trip_json(spark, f"{workdir}/{side}") for side in ("departures", "arrivals")]
        drained(paired_trips(*sides, longest="2 hours"), target, f"{workdir}/checkpoint")
    found = target.read(spark).drop("batch_id")
    return found.filter(~F.col("trip_id").eqNullSafe("FAR"))


def drained(rows: DataFrame, target: PartitionedTable, checkpoint: str) -> None:
    """A stream's rows into a table by batch, until nothing is left to read."""
    query = rows.writeStream.foreachBatch(by_batch(target)).option("checkpointLocation", checkpoint)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def mart_audit(name: str, query: Callable = from_fact) -> Query:
    mart = marts.MARTS[name]
    return query(lambda facts: non_null_audit(mart.build(facts), name, mart.non_null))


def station_daily_unique(facts: DataFrame) -> DataFrame:
    daily = marts.station_daily_activity(facts)
    return unique_audit(daily, "mart_station_daily_activity", ("trip_date", "station_id"))


QUERIES: dict[str, Query] = {
    "dim_station": dim,
    "station_rejects": lambda spark, sf_dir: station_rejects(
        fixtures.raw_stations(spark, sf_dir)
    ),
    "active_station_lookup": lookup_roles,
    "trip_normalised": normalised,
    "trip_enriched": enriched,
    "trip_reject_reasons": from_fact(reject_reasons),
    "trip_deduplicated": deduplicated,
    "trip_deduplicated_large": deduplicated_large,
    "fact_trip_large": large_fact,
    "fact_trip_large_shuffled": large_fact_shuffled,
    "fact_trip_from_files": fact_trip_from_files,
    "fact_trip_stream": fact_trip_stream,
    "trip_quarantine": trip_quarantine,
    "stream_cross_batch_dedupe": stream_cross_batch_dedupe,
    "stream_batch_replay": stream_batch_replay,
    "stream_cross_batch_versions": stream_cross_batch_versions,
    "stream_append_replay": stream_append_replay,
    "stream_odd_landing": stream_odd_landing,
    "fact_compacted": fact_compacted,
    "fact_lineage": fact_lineage,
    "station_csv_load": station_csv_load,
    "hourly_demand": from_fact(marts.hourly_demand),
    "hourly_demand_large": from_fact(marts.hourly_demand, large_fact),
    "station_daily_activity": from_stored(marts.station_daily_activity, "station_daily_activity"),
    "station_daily_activity_single_scan": from_fact(daily_of_computed),
    "station_daily_activity_large": from_fact(daily_of_computed, large_fact),
    "station_od": from_fact(marts.station_od),
    "station_od_large": from_fact(marts.station_od, large_fact),
    "mart_incremental_refresh": mart_incremental_refresh,
    "mart_refresh_by_tag": mart_refresh_by_tag,
    "build_marts_by_tag": build_marts_by_tag,
    "trips_per_day": from_fact(lambda f: questions.trips_per_day(marts.hourly_demand(f))),
    "busiest_stations": from_fact(lambda f: questions.busiest_stations(daily_of_computed(f))),
    "net_arrival_stations": from_fact(
        lambda f: questions.net_arrival_stations(daily_of_computed(f))
    ),
    "top_od_pairs": from_fact(lambda f: questions.top_od_pairs(marts.station_od(f))),
    "bike_usage": from_fact(questions.bike_usage),
    "bike_type_comparison": from_fact(questions.bike_type_comparison),
    "trip_station_as_of": as_of_query(BroadcastBudget()),
    "trip_station_as_of_merged": as_of_query(BroadcastBudget(limit_bytes=0, known_bytes=1)),
    "trip_overlaps": from_fact(movements.trip_overlaps),
    "trip_closures": trip_closures,
    "dock_balance": from_fact(movements.dock_balance),
    "dock_balance_large": from_fact(movements.dock_balance, large_fact),
    "bikes_under_way": from_fact(movements.bikes_under_way),
    "bike_relocations": from_fact(movements.bike_relocations),
    "distinct_sketches": distinct_sketches,
    "duration_sketches": duration_sketches,
    "returning_users": returning_users,
    "demand_cube": from_fact(cubes.demand_cube),
    "demand_rollup": from_fact(cubes.demand_rollup),
    "demand_grouping_sets": from_fact(some_grouping_sets),
    "load_reconciliation": load_reconciliation,
    "nearest_stations": nearest_stations,
    "stream_windows": stream_windows,
    "stream_late_trips": stream_late_trips,
    "stream_bike_sessions": stream_bike_sessions,
    "stream_paired_trips": stream_paired_trips,
    "station_preview": station_preview,
    "station_guards": station_guards,
    "stream_periodic": stream_periodic,
    "stream_empty_batch": stream_empty_batch,
    "stream_watermark_versions": stream_watermark_versions,
    "mart_load_times": mart_load_times,
    "trips_over_midnight": from_fact(questions.trips_over_midnight),
    "audit_runs": audit_runs,
    "audit_hourly_demand": mart_audit("mart_hourly_demand"),
    "audit_station_daily": mart_audit(
        "mart_station_daily_activity", lambda build: from_stored(build, "audit_station_daily")
    ),
    "audit_station_od": mart_audit("mart_station_od"),
    "audit_station_daily_unique": from_stored(station_daily_unique, "audit_station_daily_unique"),
    "audit_fact_unique": audit_fact_unique,
    "audit_store": audit_store,
    "audit_fact_trip": from_fact(
        lambda f: non_null_audit(f, "fact_trip", ("trip_id", "start_station_id", "end_time"))
    ),
    "audit_trip_repeats": lambda spark, sf_dir: unique_audit(
        normalise_trips(fixtures.raw_trips_large(spark, sf_dir)), "raw_trip", ("trip_id",)
    ),
}


def run_in_utc(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(pin_utc(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: run_in_utc(query) for name, query in QUERIES.items()}
