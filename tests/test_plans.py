"""Physical plans: what must be there at scale, and what must not."""

from __future__ import annotations

import re

import pytest

from tests.helpers import trip, trips, two_stations
from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill import fixtures
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.lookup import BroadcastBudget, active_station_lookup, payload_bytes
from tripmill.oracle_sql import ORACLE_SQL
from tripmill.plans import marts, questions
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip, enrich_trips
from tripmill.queries import queries
from tripmill.sources.tables import SnapshotTable

WRITERS = {
    "fact_trip_stream", "trip_quarantine", "stream_cross_batch_dedupe", "stream_batch_replay",
    "mart_incremental_refresh", "build_marts_by_tag", "mart_refresh_by_tag", "audit_store",
    "stream_cross_batch_versions", "stream_append_replay", "stream_odd_landing", "fact_compacted",
    "fact_lineage", "audit_fact_unique", "station_csv_load", "station_preview", "station_guards",
    "stream_periodic", "stream_empty_batch", "stream_watermark_versions", "mart_load_times",
    "stream_windows", "stream_late_trips", "stream_bike_sessions", "stream_paired_trips",
    "load_reconciliation", "audit_runs",
}


def plan_of(df) -> str:
    """The initial physical plan, one operator per line."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    table = SnapshotTable(str(tmp_path_factory.mktemp("plans") / "fact"), ("trip_date",))
    table.replace(build_fact_trip(trips(spark, trip()), build_dim_station(two_stations(spark))))
    return table.read(spark)


@pytest.mark.parametrize("name", sorted(set(queries()) - WRITERS))
def test_no_pair_joins_and_no_python(spark, data_dir, name):
    plan = plan_of(queries()[name](spark, data_dir))
    assert not re.search("CartesianProduct|NestedLoopJoin|EvalPython|InPandas|InArrow", plan)


@pytest.mark.parametrize("name", ["trip_deduplicated", "trip_deduplicated_large", "dim_station"])
def test_copies_are_limited_before_the_exchange(spark, data_dir, name):
    lines = plan_of(queries()[name](spark, data_dir)).splitlines()
    kinds = [re.search(r"WindowGroupLimit|Exchange hashpartitioning", line) for line in lines]
    assert [kind[0] for kind in kinds if kind][:3] == [
        "WindowGroupLimit", "Exchange hashpartitioning", "WindowGroupLimit"
    ]


def test_the_bound_of_the_lookup_size_holds(spark, data_dir):
    lookup = active_station_lookup(build_dim_station(fixtures.raw_stations(spark, data_dir)))
    assert payload_bytes(lookup) <= fixtures.station_budget(spark, data_dir).known_bytes


def scans(df) -> list[str]:
    return [line for line in plan_of(df).splitlines() if "FileScan" in line]


def scanned(line: str) -> set[str]:
    return set(re.search(r"FileScan parquet \[(.*?)\]", line)[1].split(","))


def test_marts_read_their_columns_of_valid_trips(stored):
    (scan,) = scans(marts.station_daily_activity(stored, single_scan=True))
    assert "is_valid_trip" in re.search(r"DataFilters: \[(.*?)\]", scan)[1]
    start, end = scans(marts.station_daily_activity(stored))
    assert not any("end_" in column for column in scanned(start))
    assert not any("start_" in column for column in scanned(end))
    (per_day,) = scans(questions.trips_per_day(marts.hourly_demand(stored)))
    unused = ("bike_id", "user_id", "trip_duration_minutes", "is_round_trip")
    assert not any(column.startswith(unused) for column in scanned(per_day))


def test_shares_read_the_fact_once(stored):
    assert len(scans(questions.bike_type_comparison(stored))) == 1


def test_dates_prune_partitions(stored):
    day = marts.station_od(stored).filter("trip_date = DATE'2024-05-01'")
    (scan,) = scans(day)
    assert "trip_date" in re.search(r"PartitionFilters: \[(.*?)\]", scan)[1]


def test_top_k_is_not_a_full_sort(stored):
    for top in (
        questions.busiest_stations(marts.station_daily_activity(stored)),
        questions.top_od_pairs(marts.station_od(stored)),
    ):
        plan = plan_of(top)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["trip_enriched", "fact_trip_large", "fact_trip_stream"])
def test_same_rows_when_the_lookup_is_too_large_to_broadcast(spark, data_dir, monkeypatch, name):
    def nothing_fits(spark, sf_dir):
        return BroadcastBudget(limit_bytes=0, known_bytes=1)

    monkeypatch.setattr(fixtures, "station_budget", nothing_fits)
    result = queries()[name](spark, data_dir)
    expected = rows_of_sql(connect(data_dir), ORACLE_SQL[name])
    assert rows_of_spark(result) == expected


def test_trips_are_built_by_more_tasks_than_their_table_has_row_groups(spark, data_dir):
    plan = plan_of(fixtures.raw_trips(spark, data_dir))
    assert re.search(r"Exchange hashpartitioning\(event_id", plan)


def test_trips_are_built_by_as_many_tasks_as_cores_and_rows_ask_for(spark, data_dir, monkeypatch):
    def tasks():
        plan = plan_of(fixtures.raw_trips(spark, data_dir))
        return int(re.search(r"Exchange hashpartitioning\(event_id[^)]*, (\d+)\)", plan)[1])

    assert tasks() == 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(fixtures, "TRIPS_PER_TASK", 100)
    assert tasks() == fixtures.table(spark, data_dir, "events").count() // 100


def test_rows_are_rebalanced_before_joins_that_shuffle_nothing(spark):
    raw, dim = trips(spark, trip(), trip("2", start_station_id="x")), two_stations(spark)
    trip_rows, stations = normalise_trips(raw), build_dim_station(dim)
    found = []
    for limit in (64 << 20, 0):
        facts = enrich_trips(
            trip_rows, stations, BroadcastBudget(limit_bytes=limit), write_by=["trip_date"]
        )
        plan = facts._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RebalancePartitions") == 1
        assert (plan.index("RebalancePartitions") < plan.index("Join")) == (limit == 0)
        found.append(sorted(map(str, facts.drop("load_dt").collect())))
    assert found[0] == found[1] and len(found[0]) == 2


def test_a_lookup_whose_bound_is_too_large_is_measured(spark, data_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "LOOKUP_ROW_BYTES", 1 << 40)
    budget = fixtures.station_budget(spark, data_dir)
    lookup = active_station_lookup(build_dim_station(fixtures.raw_stations(spark, data_dir)))
    assert budget.admits(lookup)
    assert budget.measured(lookup).known_bytes == payload_bytes(lookup)


def test_derived_columns_are_not_shuffled(spark):
    raw, nothing_fits = trips(spark, trip()), BroadcastBudget(limit_bytes=0, known_bytes=1)
    facts = build_fact_trip(raw, build_dim_station(two_stations(spark)), nothing_fits)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS trip_hour") == 1
    assert plan.index("AS trip_hour") < plan.index("Join")


def test_visits_of_large_trips_read_their_columns(spark, data_dir):
    visits = fixtures.raw_trips_large(spark, data_dir).select("start_station_id", "end_station_id")
    columns = set.union(*[scanned(line) for line in scans(visits) if "l_suppkey" in line])
    assert {re.sub("#.*", "", c) for c in columns} == {"l_orderkey", "l_partkey", "l_suppkey"}
