from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import stations, trip, trips, two_stations
from tripmill.functions.numbers import exact_mean, half_up_quotient
from tripmill.operators.checks import audit_history, non_null_audit, unique_audit
from tripmill.plans import marts, questions
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip
from tripmill.plans.refresh import AuditFailed, audit_mart, build_marts, partitioned_marts
from tripmill.sources.tables import ConnectorTable

DAY = dt.date(2024, 5, 1)


@pytest.fixture(scope="module")
def facts(spark):
    dim = build_dim_station(two_stations(spark))
    events = [
        trip("1"),
        trip("2", bike_id="bk2", end_time="2024-05-01T10:00:20+00:00"),
        trip("3", user_id="u2", start_station_id="b", end_station_id="b"),
        trip("4", start_time="2024-05-01T23:50:00+00:00", end_time="2024-05-02T00:10:00+00:00"),
        trip("5", end_time=None),
        trip("6", start_station_id="b", end_station_id="a", user_type=None),
    ]
    return build_fact_trip(trips(spark, *events), dim)


def rows(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def test_hourly_demand(facts):
    found = rows(
        marts.hourly_demand(facts), "trip_hour", "start_neighbourhood", "user_type", "trip_count",
        "active_bikes", "active_users", "avg_trip_duration_minutes", "round_trip_count",
    )
    assert found == {
        (10, "North", "member", 2, 2, 1, 15.17, 0),  # (30 + 0.33) / 2 = 15.165, half up
        (10, "South", "member", 1, 1, 1, 30.0, 1),
        (10, "South", None, 1, 1, 1, 30.0, 0),
        (23, "North", "member", 1, 1, 1, 20.0, 0),
    }


def test_arrivals_count_on_the_start_date(facts):
    for single_scan in (False, True):
        daily = marts.station_daily_activity(facts, single_scan)
        found = rows(
            daily, "trip_date", "station_id", "trip_starts", "trip_ends", "net_outflow",
            "avg_start_trip_duration_minutes", "avg_end_trip_duration_minutes",
        )
        assert found == {(DAY, "A", 3, 1, 2, 16.78, 30.0), (DAY, "B", 2, 4, -2, 30.0, 20.08)}


def test_one_sided_stations_have_zero_and_null(spark):
    dim = build_dim_station(two_stations(spark))
    daily = marts.station_daily_activity(build_fact_trip(trips(spark, trip()), dim))
    found = rows(daily, "station_id", "trip_starts", "trip_ends",
                 "avg_start_trip_duration_minutes", "avg_end_trip_duration_minutes")
    assert found == {("A", 1, 0, 30.0, None), ("B", 0, 1, None, 30.0)}


def test_a_rename_within_a_day_fans_out_and_is_reported(spark):
    names = [("a", "Alpha", "North", True), ("b", "Beta", "South", True)]
    renamed = [("a", "Alef", "North", True), names[1]]
    before = build_fact_trip(
        trips(spark, trip("1"), trip("2", start_station_id="b", end_station_id="a")),
        build_dim_station(stations(spark, *names)),
    )
    after = build_fact_trip(trips(spark, trip("3")), build_dim_station(stations(spark, *renamed)))
    daily = marts.station_daily_activity(before.unionByName(after))
    found = rows(daily, "station_id", "station_name", "trip_starts", "trip_ends")
    assert found == {("A", "Alpha", 1, 1), ("A", "Alef", 1, 1), ("B", "Beta", 1, 2)}
    audit = audit_mart(marts.MARTS["mart_station_daily_activity"], daily)
    assert rows(audit, "column_name", "violations") == {
        ("trip_date", 0), ("station_id", 0), ("trip_date,station_id", 1)
    }


def test_totals_agree_between_marts(facts):
    valid = facts.filter("is_valid_trip").count()
    hourly = marts.hourly_demand(facts).agg(F.sum("trip_count")).first()[0]
    od = marts.station_od(facts).agg(F.sum("trip_count")).first()[0]
    daily = marts.station_daily_activity(facts)
    starts, ends, net = daily.agg(
        F.sum("trip_starts"), F.sum("trip_ends"), F.sum("net_outflow")
    ).first()
    assert (valid, hourly, od, starts, ends, net) == (5, 5, 5, 5, 5, 0)


def test_result_does_not_depend_on_partitioning(facts):
    columns = [c for c in marts.hourly_demand(facts).columns if c != "mart_load_dt"]
    expected = rows(marts.hourly_demand(facts), *columns)
    for shuffled in (facts.repartition(7), facts.orderBy(F.rand(3)).coalesce(1)):
        assert rows(marts.hourly_demand(shuffled), *columns) == expected


def test_questions(facts):
    daily, od = marts.station_daily_activity(facts), marts.station_od(facts)
    per_day = questions.trips_per_day(marts.hourly_demand(facts))
    assert rows(per_day, "trip_date", "trips") == {(DAY, 5)}
    busiest = questions.busiest_stations(daily, k=1)
    assert rows(busiest, "station_id", "trips") == {("B", 6)}
    arrivals = questions.net_arrival_stations(daily)
    assert rows(arrivals, "station_id", "net_outflow") == {("B", -2)}
    pairs = [tuple(r) for r in questions.top_od_pairs(od, k=2).collect()]
    assert pairs == [("A", "B", 3), ("B", "A", 1)]
    assert rows(questions.bike_usage(facts), "bike_id", "trips", "active_days", "minutes") == {
        ("BK1", 4, 1, 110.0), ("BK2", 1, 1, 0.33)
    }
    (line,) = questions.bike_type_comparison(facts).collect()
    assert tuple(line) == ("classic", 5, 1.0, 22.07, 1, 0.2)


def test_exact_rounding(spark):
    cases = spark.createDataFrame([(5, 2), (-5, 2), (4, 3), (7, 7), (0, 5)], "a long, b long")
    assert [r[0] for r in cases.select(half_up_quotient(F.col("a"), F.col("b"))).collect()] == [
        3, -3, 1, 1, 0
    ]
    ties = spark.createDataFrame([(0.14,), (0.15,), (None,)], "d double")
    assert ties.agg(exact_mean(F.col("d"))).first()[0] == 0.15
    assert ties.filter("d is null").agg(exact_mean(F.col("d"))).first()[0] is None


def test_audits(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, None)], "a int, b string")
    assert rows(non_null_audit(df, "t", ("a", "b")), "column_name", "violations") == {
        ("a", 1), ("b", 2)
    }
    assert rows(unique_audit(df, "t", ("a",)), "check_name", "violations") == {("t", 1)}


def test_marts_by_tag_are_built_partitioned_and_audited(spark, facts, tmp_path):
    audit_target = ConnectorTable(format="parquet", options={"path": str(tmp_path / "audit")})
    target_of = partitioned_marts(str(tmp_path / "gold"))
    audit = build_marts(facts, target_of, tags=("station",), audit_target=audit_target)
    assert audit.agg(F.sum("violations")).first()[0] == 0
    stored = audit_target.read(spark)
    assert {r.check_name for r in stored.collect()} == {
        "mart_station_daily_activity", "mart_station_od"
    }
    assert stored.filter("run_dt is null").isEmpty()
    od = target_of(marts.MARTS["mart_station_od"]).read(spark)
    assert f"trip_date={DAY}" in od.inputFiles()[0]
    assert od.schema["trip_date"].dataType.simpleString() == "date"
    assert not target_of(marts.MARTS["mart_hourly_demand"]).exists(spark)
    with pytest.raises(LookupError):
        build_marts(facts, target_of, tags=("nothing",))
    # A second refresh replaces, it does not add.
    before = od.count()
    build_marts(facts, target_of, tags=("od",))
    assert target_of(marts.MARTS["mart_station_od"]).read(spark).count() == before


def test_a_failed_audit_keeps_the_old_rows(spark, facts, tmp_path):
    audit_target = ConnectorTable(format="parquet", options={"path": str(tmp_path / "audit")})
    target_of = partitioned_marts(str(tmp_path / "gold"))
    build_marts(facts, target_of, ("od", "hourly"))
    od, hourly = (
        target_of(marts.MARTS[name]) for name in ("mart_station_od", "mart_hourly_demand")
    )
    before = sorted(map(str, od.read(spark).collect()))
    # A valid trip without an end station is what no load writes.
    broken = facts.withColumn("end_station_id", F.lit(None).cast("string")).unionByName(facts)
    with pytest.raises(AuditFailed, match="mart_station_od.end_station_id"):
        build_marts(broken, target_of, ("od", "hourly"), audit_target)
    assert sorted(map(str, od.read(spark).collect())) == before
    assert hourly.read(spark).agg(F.sum("trip_count")).first()[0] == 10
    assert audit_target.read(spark).agg(F.sum("violations")).first()[0] > 0


def test_registry():
    assert {m.name for m in marts.marts_tagged()} == set(marts.MARTS)
    assert [m.name for m in marts.marts_tagged(["hourly"])] == ["mart_hourly_demand"]


def test_audit_history(spark):
    rows = [("m", "a", 0, 1), ("m", "a", 4, 2), ("m", "a", 1, 3), ("m", "a", 1, 3), ("m", "b", 0, 3)]
    lines = spark.createDataFrame(rows, "check_name string, column_name string, violations long, t int")
    history = audit_history(lines.selectExpr("* except (t)", "timestamp_seconds(t) as run_dt"))
    found = {r["column_name"]: r for r in history.collect()}
    assert [found["a"][c] for c in ("runs", "failed_runs", "last_violations")] == [3, 2, 1]
    assert found["a"]["last_failed_dt"] == found["a"]["last_run_dt"]
    assert found["b"]["runs"] == 1 and found["b"]["last_failed_dt"] is None


def test_trips_over_midnight(spark):
    def ends(trip_id, day, hour):
        return trip(trip_id, start_time="2024-05-01T23:00:00+00:00", end_time=f"2024-05-0{day}T{hour}:30:00+00:00")

    events = [ends("1", 1, 23), ends("2", 2, "00"), ends("3", 2, "05"), ends("4", 3, "00")]
    facts = build_fact_trip(trips(spark, *events), build_dim_station(two_stations(spark)))
    rows = questions.trips_over_midnight(facts).collect()
    assert sorted((r["days_later"], r["trip_count"]) for r in rows) == [(1, 2), (2, 1)]
