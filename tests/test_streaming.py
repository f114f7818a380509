from __future__ import annotations

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.helpers import by_id, land, stations, trip, trips, two_stations
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.lookup import BroadcastBudget
from tripmill.operators.survivors import latest_trip
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip
from tripmill.plans.marts import MARTS, hourly_demand
from tripmill.plans.refresh import (
    partitioned_marts,
    refresh_logs,
    refresh_touched_dates,
)
from tripmill.schemas import FACT_TRIP_COLUMNS
from tripmill.sources.files import land_trips, read_trip_json
from tripmill.sources.tables import ConnectorTable, PartitionedTable, SnapshotTable
from tripmill.streaming.job import drain_trip_stream, start_trip_stream
from tripmill.streaming.sink import (
    AppendSink,
    TripSink,
    fact_table,
    load_table,
    parsed_once,
    quarantine_table,
    version,
)

DAY = "2024-05-01"


class Pipeline:
    def __init__(self, spark, root, **sink_options):
        self.spark, self.root = spark, root
        self.landing = root / "landing"
        self.landing.mkdir()
        self.stations = SnapshotTable(str(root / "dim"))
        self.stations.replace(build_dim_station(two_stations(spark)))
        self.sink = TripSink(
            fact_table(str(root / "fact")),
            quarantine_table(str(root / "quarantine")),
            self.stations.read,
            **sink_options,
        )

    def drain(self, checkpoint="checkpoint", **options):
        drain_trip_stream(
            self.spark, str(self.landing), str(self.root / checkpoint), self.sink, **options
        )
        return self.fact

    @property
    def fact(self):
        return self.sink.fact.read(self.spark)


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, tmp_path)


def test_landed_files_become_facts(spark, pipeline):
    land(pipeline.landing, DAY, "a", trip("1"), trip("2", extra=1, bike_id=5), "{bad")
    land(pipeline.landing, "2024-05-02", "b", trip("3"), trip("3"), trip(None), "{worse")
    fact = pipeline.drain()
    assert by_id(fact, "bike_id", "is_valid_trip") == {
        "1": ("BK1", True), "2": ("5", True), "3": ("BK1", True)
    }
    assert set(fact.columns) == {*FACT_TRIP_COLUMNS, "load_batch"}
    assert fact.filter("file_name not like '%landing/ingest_date=%.jsonl'").isEmpty()
    lost = pipeline.sink.quarantine.read(spark)
    assert {r._corrupt_record for r in lost.collect()} == {None, "{bad", "{worse"}
    raw = read_trip_json(spark, str(pipeline.landing), ingest_from="2024-05-02")
    assert raw.count() == 4
    batch = build_fact_trip(
        read_trip_json(spark, str(pipeline.landing)), pipeline.stations.read(spark)
    )
    columns = [c for c in FACT_TRIP_COLUMNS if c != "load_dt"]
    assert batch.select(*columns).exceptAll(fact.select(*columns)).isEmpty()
    assert batch.count() == fact.count()


def test_copies_in_later_files_and_runs_are_left_out(pipeline):
    for name in "abc":
        land(pipeline.landing, DAY, name, trip("same"), trip(name))
    assert sorted(by_id(pipeline.drain(max_files=1), "bike_id")) == ["A", "B", "C", "SAME"]
    assert pipeline.fact.count() == 4
    first = by_id(pipeline.fact, "load_batch")
    land(pipeline.landing, DAY, "d", trip("a"), trip("d"))
    assert pipeline.drain().count() == 5
    assert by_id(pipeline.fact, "load_batch").items() >= first.items()
    assert pipeline.drain().count() == 5


def test_a_fresh_checkpoint_neither_repeats_nor_overwrites(pipeline):
    land(pipeline.landing, DAY, "a", trip("1"))
    pipeline.drain()
    land(pipeline.landing, DAY, "b", trip("2"))
    assert sorted(by_id(pipeline.drain("second_checkpoint"), "bike_id")) == ["1", "2"]
    assert pipeline.fact.count() == 2


@pytest.mark.parametrize("limit_bytes", [64 << 20, 0])
def test_replay_replaces_itself(spark, tmp_path, limit_bytes):
    pipeline = Pipeline(
        spark, tmp_path, stream_id="s", budget=BroadcastBudget(limit_bytes=limit_bytes)
    )
    sink = pipeline.sink
    no_time = trip("3", start_time="x")
    sink(trips(spark, trip("1"), trip(None)), 0)
    for _ in range(2):
        sink(trips(spark, trip("1"), trip("2"), trip("2"), no_time, trip(None)), 1)
    sink(trips(spark, no_time, trip("2")), 2)
    assert by_id(pipeline.fact, "load_batch") == {"1": "s-0", "2": "s-1", "3": "s-1"}
    assert pipeline.fact.count() == 3
    assert sink.quarantine.read(spark).count() == 2


def far(year, trip_id):
    return trip(
        trip_id,
        start_time=f"{year}-05-01T10:00:00+00:00",
        end_time=f"{year}-05-01T10:30:00+00:00",
    )


def test_far_years_pass_load_look_up_and_refresh(spark, pipeline):
    sink = TripSink(
        pipeline.sink.fact, pipeline.sink.quarantine, pipeline.stations.read, stream_id="s"
    )
    years = ("0000", "0001", "9999", "12345")
    events = [far(year, f"y{year}") for year in years] + [trip("none", start_time=None)]
    for batch_id in range(2):
        sink(trips(spark, *events, trip(f"new{batch_id}")), batch_id)
    assert pipeline.fact.count() == len(events) + 2
    assert pipeline.fact.filter("load_batch = 's-0'").count() == len(events) + 1
    log_of, target_of = (make(str(pipeline.root / "gold")) for make in (refresh_logs, partitioned_marts))
    dates = refresh_touched_dates(spark, sink.fact, log_of, target_of)
    assert len(dates) == len(events) + 1 and None in dates
    daily = target_of(MARTS["mart_station_daily_activity"]).read(spark)
    assert daily.agg(F.sum("trip_starts")).first()[0] == len(years) + 2


def test_files_of_every_name_are_read(spark, pipeline):
    folder = pipeline.landing / f"ingest_date={DAY}"
    for name in ("a.jsonl", "b.ndjson", "c.txt", "part-00000", "d.x.y"):
        land(pipeline.landing, DAY, "a", trip(name))
        (folder / "trip_events_a.jsonl").rename(folder / name)
    assert pipeline.drain().count() == 5
    assert read_trip_json(spark, str(pipeline.landing)).count() == 5


def test_unreadable_creation_times_land(spark, tmp_path):
    land_trips(trips(spark, trip("1", event_created_at="soon"), trip("2")), str(tmp_path / "l"))
    assert read_trip_json(spark, str(tmp_path / "l")).count() == 2


@pytest.mark.parametrize("max_files", [1, 1000])
@pytest.mark.parametrize("latest_first", [True, False])
def test_the_latest_version_survives_in_any_batches(pipeline, max_files, latest_first):
    hours = (12, 10, 11) if latest_first else (10, 11, 12)
    for hour in hours:
        created = f"2024-05-01T{hour}:00:00+00:00"
        event = trip("1", bike_id=f"h{hour}", event_created_at=created)
        land(pipeline.landing, DAY, f"f{hour}", event, trip(f"own{hour}"))
    for _ in range(2):
        fact = pipeline.drain(max_files=max_files)
        assert by_id(fact, "bike_id")["1"] == "H12"
        assert fact.count() == 4


def test_a_replay_of_a_beaten_load_shows_the_latest_version(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path, stream_id="s")
    for batch_id, hour in ((0, 10), (1, 11), (0, 10), (1, 11)):
        created = f"2024-05-01T{hour}:00:00+00:00"
        pipeline.sink(trips(spark, trip("1", event_created_at=created)), batch_id)
    assert by_id(pipeline.fact, "load_batch") == {"1": "s-1"}
    assert pipeline.fact.count() == 1


@pytest.mark.parametrize("broken", ["fact", "fact_loads"])
def test_a_failure_between_two_writes_shows_no_trip_twice(spark, tmp_path, monkeypatch, broken):
    """The second version's load fails before or after its rows are there; then it is replayed."""
    pipeline = Pipeline(spark, tmp_path, stream_id="s")
    later = {"event_created_at": "2024-05-01T12:00:00+00:00", "bike_id": "later"}
    pipeline.sink(trips(spark, trip("1"), trip("2")), 0)
    real = PartitionedTable.replace_partitions

    def failing(table, df):
        if table.path.endswith(f"/{broken}"):
            raise OSError("no space left")
        real(table, df)

    monkeypatch.setattr(PartitionedTable, "replace_partitions", failing)
    with pytest.raises(OSError, match="no space"):
        pipeline.sink(trips(spark, trip("1", **later), trip("3")), 1)
    written = broken == "fact_loads"
    shown = {"1": "LATER" if written else "BK1", "2": "BK1"} | ({"3": "BK1"} if written else {})
    assert by_id(pipeline.fact, "bike_id") == shown
    assert pipeline.fact.count() == len(shown)
    monkeypatch.undo()
    pipeline.sink(trips(spark, trip("1", **later), trip("3")), 1)
    assert by_id(pipeline.fact, "bike_id") == {"1": "LATER", "2": "BK1", "3": "BK1"}
    assert pipeline.fact.count() == 3


def test_dates_without_versions_are_read_as_they_are(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path, stream_id="s")

    def on(day, hour):
        return {f"{c}_time": f"2024-05-0{day}T1{i}:00:00+00:00" for i, c in enumerate(("start", "end"))} | {
            "event_created_at": f"2024-05-0{day}T{hour}:00:00+00:00"
        }

    pipeline.sink(trips(spark, trip("1", **on(1, 12)), trip("2", **on(2, 12))), 0)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(pipeline.fact)
    pipeline.sink(trips(spark, trip("2", **on(2, 13)), trip("3", **on(3, 12))), 1)
    assert pipeline.fact.count() == 3
    assert pipeline.sink.fact.read_versions(spark).count() == 4
    assert "Exchange" in plan(pipeline.fact)
    first = pipeline.sink.fact.read_slices(spark, ["2024-05-01"])
    assert "Exchange" not in plan(first) or first.count() == 1
    assert pipeline.sink.fact.read_slices(spark, ["2024-05-02"]).count() == 1
    assert pipeline.sink.fact.read_slices(spark, ["1999-01-01"]) is None


def test_slices_of_a_trip_that_has_moved_to_another_date(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path, stream_id="s", match_dates=False)
    for batch_id, day in enumerate((1, 2)):
        times = {c: f"2024-05-0{day}T10:{m}:00+00:00" for c, m in (("start_time", "00"), ("end_time", "30"),
                                                                 ("event_created_at", "40"))}
        pipeline.sink(trips(spark, trip("1", **times), trip(f"own{day}", **times)), batch_id)
    read = pipeline.sink.fact.read_slices
    assert sorted(by_id(read(spark, ["2024-05-01"]), "bike_id")) == ["OWN1"]
    assert sorted(by_id(read(spark, ["2024-05-02"]), "bike_id")) == ["1", "OWN2"]
    assert pipeline.fact.count() == 3


@pytest.mark.parametrize(("match_dates", "expected"), [(True, 2), (False, 1)])
def test_a_resent_trip_that_changes_its_date(spark, tmp_path, match_dates, expected):
    pipeline = Pipeline(spark, tmp_path, stream_id="s", match_dates=match_dates)
    for batch_id, day in enumerate((1, 2)):
        start, end = (f"2024-05-0{day}T10:{minute}:00+00:00" for minute in ("00", "30"))
        pipeline.sink(trips(spark, trip("1", start_time=start, end_time=end)), batch_id)
    assert pipeline.fact.count() == expected


def test_late_events_are_kept_however_late(pipeline):
    land(pipeline.landing, DAY, "a", trip("1"))
    pipeline.drain()
    long_ago = dict(
        start_time="2001-05-01T10:00:00+00:00", end_time="2001-05-01T10:05:00+00:00",
        event_created_at="2001-05-01T10:05:00+00:00",
    )
    land(pipeline.landing, DAY, "b", trip("2", **long_ago))
    assert by_id(pipeline.drain(), "is_valid_trip") == {"1": True, "2": True}


def test_watermark_form_drops_copies_and_late_rows(pipeline):
    sink = TripSink(
        pipeline.sink.fact, pipeline.sink.quarantine, pipeline.stations.read, skip_known=False
    )

    def drain():
        drain_trip_stream(
            pipeline.spark, str(pipeline.landing), str(pipeline.root / "wm"), sink,
            watermark_delay="1 hour",
        )
        return sorted(r.trip_id for r in pipeline.fact.collect())

    def created(hour):
        return {"event_created_at": f"2024-05-01T{hour}:00:00+00:00"}

    land(pipeline.landing, DAY, "a", trip("1", **created(10)), trip("1", **created(10)))
    land(pipeline.landing, DAY, "a2", trip("1", **created(10)))
    assert drain() == ["1"]
    land(pipeline.landing, DAY, "b", trip("1", **created(10)), trip("2", **created(15)))
    assert drain() == ["1", "2"]
    land(pipeline.landing, DAY, "c", trip("late", **created(11)), trip("3", **created(15)))
    assert drain() == ["1", "2", "3"]
    # What cannot be told apart is no late row: it reaches the fact or the quarantine.
    odd = (trip("4", event_created_at="soon"), trip(None, **created(1)), "{bad")
    land(pipeline.landing, DAY, "d", *odd)
    assert drain() == ["1", "2", "3", "4"]
    assert pipeline.sink.quarantine.read(pipeline.spark).count() == 2


def test_refreshed_dimension_takes_effect_with_the_next_batch(spark, pipeline):
    land(pipeline.landing, DAY, "a", trip("1", start_station_id="c"))
    pipeline.drain()
    opened = build_dim_station(
        stations(spark, ("b", "Beta", "South", True), ("c", "Closed", "South", True))
    )
    pipeline.stations.replace(opened)
    land(pipeline.landing, DAY, "b", trip("2", start_station_id="c"))
    assert by_id(pipeline.drain(), "is_valid_trip") == {"1": False, "2": True}


def test_empty_batch_writes_nothing(spark, pipeline):
    sink = TripSink(
        pipeline.sink.fact, pipeline.sink.quarantine, pipeline.stations.read, stream_id="s"
    )
    sink(trips(spark, trip()).limit(0), 0)
    assert not sink.fact.exists(spark) and sink.fact.read(spark).isEmpty()


def test_continuous_stream_picks_up_new_files(pipeline):
    land(pipeline.landing, DAY, "a", trip("1"))
    query = start_trip_stream(
        pipeline.spark, str(pipeline.landing), str(pipeline.root / "live"), pipeline.sink,
        processing_time="200 milliseconds",
    )
    try:
        query.processAllAvailable()
        assert not query.awaitTermination(1)
        land(pipeline.landing, DAY, "b", trip("2"))
        deadline = time.time() + 60
        while pipeline.fact.count() < 2 and time.time() < deadline:
            query.processAllAvailable()
        assert sorted(by_id(pipeline.fact, "bike_id")) == ["1", "2"]
    finally:
        query.stop()


def test_append_sink(spark, pipeline):
    fact, quarantine = (
        ConnectorTable(format="parquet", options={"path": str(pipeline.root / name)})
        for name in ("appended", "appended_quarantine")
    )
    sink = AppendSink(fact, quarantine, pipeline.stations.read, stream_id="s")
    first = (trip("1"), trip("1"), trip(None), "{bad")
    land(pipeline.landing, DAY, "a", *first)
    drain_trip_stream(spark, str(pipeline.landing), str(pipeline.root / "cp"), sink)
    sink(trips(spark, trip()).limit(0), 1)
    # A replay in whole or in part, and copies in a later batch, add nothing.
    sink(trips(spark, trip("1"), trip(None)), 0)
    sink(trips(spark, trip("1"), trip("2")), 2)
    assert by_id(fact.read(spark), "load_batch") == {"1": "s-0", "2": "s-2"}
    assert fact.read(spark).count() == 2
    assert quarantine.read(spark).count() == 2


def test_only_touched_dates_are_rewritten(spark, pipeline):
    sink = TripSink(
        pipeline.sink.fact, pipeline.sink.quarantine, pipeline.stations.read, stream_id="s"
    )
    gold = str(pipeline.root / "gold")
    log_of, target_of = refresh_logs(gold), partitioned_marts(gold)
    second_day = dict(
        start_time="2024-05-02T10:00:00+00:00", end_time="2024-05-02T10:30:00+00:00"
    )

    def refresh(**options):
        return refresh_touched_dates(spark, sink.fact, log_of, target_of, **options)

    assert refresh() == []
    sink(trips(spark, trip("1"), trip("2", **second_day)), 0)
    assert refresh(tags=("od",)) == ["2024-05-01", "2024-05-02"]
    assert refresh(tags=("od",)) == []
    assert refresh() == ["2024-05-01", "2024-05-02"]
    hourly = target_of(MARTS["mart_hourly_demand"])
    untouched = hourly.read_slices(spark, ["2024-05-01"]).inputFiles()
    sink(trips(spark, trip("3", **second_day)), 1)
    assert refresh() == ["2024-05-02"]
    assert hourly.read_slices(spark, ["2024-05-01"]).inputFiles() == untouched
    assert refresh() == []
    columns = [c for c in hourly.read(spark).columns if c != "mart_load_dt"]
    full = hourly_demand(sink.fact.read(spark)).select(*columns)
    assert full.exceptAll(hourly.read(spark).select(*columns)).isEmpty()
    assert hourly.read(spark).agg(F.sum("trip_count")).first()[0] == 3
    assert refresh(everything=True) == ["2024-05-01", "2024-05-02"]
    assert refresh() == []
    # A replay after the dimension has changed is a new attempt with other rows.
    pipeline.stations.replace(build_dim_station(stations(spark, ("b", "Beta", "South", True))))
    sink(trips(spark, trip("3", **second_day)), 1)
    assert refresh() == ["2024-05-02"]
    assert hourly.read(spark).agg(F.sum("trip_count")).first()[0] == 2


def test_refresh_reads_only_touched_dates(spark, pipeline, monkeypatch):
    sink = TripSink(
        pipeline.sink.fact, pipeline.sink.quarantine, pipeline.stations.read, stream_id="s"
    )
    gold = str(pipeline.root / "gold")
    sink(trips(spark, far("2001", "1"), trip("2")), 0)
    refresh_touched_dates(spark, sink.fact, refresh_logs(gold), partitioned_marts(gold))
    sink(trips(spark, trip("3")), 1)
    read = []
    monkeypatch.setattr(
        PartitionedTable,
        "read_slices",
        lambda table, session, dates, real=PartitionedTable.read_slices: (
            read.append((table.path, list(dates))) or real(table, session, dates)
        ),
    )
    monkeypatch.setattr(
        PartitionedTable,
        "read",
        lambda table, session, real=PartitionedTable.read: (
            read.append((table.path, None)) or real(table, session)
        ),
    )
    refresh_touched_dates(spark, sink.fact, refresh_logs(gold), partitioned_marts(gold))
    assert {str(dates) for path, dates in read if path == sink.fact.path} == {f"['{DAY}']"}


def test_only_rows_without_an_id_are_kept_as_they_came(spark):
    kept = parsed_once(trips(spark, trip("1"), trip(None, bike_id=" x ")))
    assert not {"trip_hour", "trip_duration_minutes", "is_round_trip"} & set(kept.columns)
    assert [(r.trip_id, r._raw and r._raw.bike_id) for r in kept.sort("trip_id").collect()] == [
        (None, " x "), ("1", None)
    ]
    kept.unpersist()


@pytest.mark.parametrize("match_dates", [True, False])
def test_a_load_is_shuffled_once_for_its_comparison(spark, tmp_path, match_dates):
    sink = Pipeline(spark, tmp_path, stream_id="s", match_dates=match_dates).sink
    raw = trips(spark, trip("1"), trip("2"))
    sink(raw, 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        stored = sink.fact.read_versions(spark).withColumn("version", version())
        met = sink._compare(latest_trip(normalise_trips(raw)), stored)
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize(("match_dates", "limit_bytes"), [(True, 0), (False, 64 << 20)])
def test_a_replay_is_not_compared_with_itself(
    spark, tmp_path, monkeypatch, match_dates, limit_bytes
):
    """Only rows of other loads, on the dates of the batch if these count, need a comparison."""
    compared, real = [], TripSink._compare

    def compare(sink, new, stored):
        compared.append(stored.count())
        return real(sink, new, stored)

    monkeypatch.setattr(TripSink, "_compare", compare)
    options = {"match_dates": match_dates, "budget": BroadcastBudget(limit_bytes=limit_bytes)}
    sink = Pipeline(spark, tmp_path, stream_id="s", **options).sink
    later = {"event_created_at": "2024-05-01T12:00:00+00:00", "bike_id": "later"}
    for batch_id in (0, 0):
        sink(trips(spark, trip("1"), trip("2"), trip(None)), batch_id)
    assert compared == []
    assert load_table(sink.fact).read(spark).count() == 1
    sink(trips(spark, trip("2"), trip("1", **later)), 1)
    assert compared == [2]
    sink(trips(spark, trip("1"), trip("2"), trip(None)), 0)
    assert compared == [2, 1]
    assert by_id(sink.fact.read(spark), "bike_id") == {"1": "LATER", "2": "BK1"}
    assert sink.quarantine.read(spark).count() == 1


@pytest.mark.parametrize(("hour", "written"), [(9, 0), (11, 0), (12, 0), (13, 1)])
def test_a_version_among_several_stored_ones(spark, tmp_path, hour, written):
    def at(hour):
        return trip("1", event_created_at=f"2024-05-01T{hour:02}:00:00+00:00")

    pipeline = Pipeline(spark, tmp_path, stream_id="s", skip_known=False)
    for batch_id, stored in enumerate((10, 12, 12)):
        pipeline.sink(trips(spark, at(stored)), batch_id)
    sink = replace(pipeline.sink, skip_known=True)
    sink(trips(spark, at(hour), trip("2")), 3)
    loaded = pipeline.sink.fact.read_versions(spark).filter("load_batch = 's-3'")
    assert sorted(r.trip_id for r in loaded.collect()) == ["1"] * written + ["2"]
    noted = sink.fact.versions.read(spark).filter("load_batch = 's-3'").count()
    assert noted == (1 if hour > 10 else 0)


def test_a_stream_with_state_keeps_it_on_disk_and_rebalances_its_writes(spark, pipeline):
    sent = [trip(str(n), event_created_at=f"{DAY}T10:{n}:00+00:00") for n in range(10, 50)]
    for name in range(4):
        land(pipeline.landing, DAY, str(name), *sent[name::4])
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")
    before = [spark.conf.get(name) for name in names]
    options = {"watermark_delay": "1 hour", "state_partitions": 5}
    assert pipeline.drain(**options).count() == 40
    assert [spark.conf.get(name) for name in names] == before
    state = pipeline.root / "checkpoint" / "state" / "0"
    assert {f.name for f in state.iterdir() if f.name.isdigit()} == {str(n) for n in range(5)}
    assert list(state.glob("0/*.zip")) and not list(state.glob("0/*.delta"))
    # One file of the date, where every task wrote one.
    assert len(list((pipeline.root / "fact").glob("*/*/*.parquet"))) == 1
    land(pipeline.landing, DAY, "again", *sent[:10], trip("new"))
    assert pipeline.drain(**options).count() == 41


def test_a_state_store_that_the_session_names_is_kept(spark, pipeline):
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, spark.conf.get(provider))
    try:
        land(pipeline.landing, DAY, "a", trip("1"))
        assert pipeline.drain(watermark_delay="1 hour").count() == 1
    finally:
        spark.conf.unset(provider)
    assert list((pipeline.root / "checkpoint" / "state" / "0").glob("0/*.delta"))
