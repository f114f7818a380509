from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import by_id, stations, trip, trips, two_stations
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.lookup import (
    BroadcastBudget,
    active_station_lookup,
    hot_stations,
    join_stations,
    payload_bytes,
)
from tripmill.operators.validity import reject_reasons
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip, enrich_trips
from tripmill.schemas import FACT_TRIP_COLUMNS

SHUFFLED = BroadcastBudget(limit_bytes=0)


@pytest.fixture(scope="module")
def dim(spark):
    return build_dim_station(two_stations(spark))


def fact(spark, dim, *events, budget=BroadcastBudget()):
    return build_fact_trip(trips(spark, *events), dim, budget)


def test_columns_and_normalisation(spark, dim):
    facts = fact(spark, dim, trip(" t1 ", user_type=" Member ", bike_type="E-BIKE "))
    assert facts.columns == FACT_TRIP_COLUMNS
    row = facts.first()
    assert (row.trip_id, row.user_type, row.bike_type) == ("T1", "member", "e-bike")
    assert (row.start_station_name, row.end_neighbourhood) == ("Alpha", "South")
    assert (row.trip_duration_minutes, row.trip_hour, row.is_valid_trip) == (30.0, 10, True)


@pytest.mark.parametrize("text", ["garbage", "", None, "2024-13-01T00:00:00+00:00"])
def test_unreadable_time_is_null_and_invalid(spark, dim, text):
    row = fact(spark, dim, trip(start_time=text)).first()
    assert row.start_time is None and row.trip_date is None
    assert row.trip_duration_minutes is None and row.is_valid_trip is False


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-05-01T10:00:05.123456+00:00", datetime(2024, 5, 1, 10, 0, 5, 123456)),
        ("2024-05-01T10:00:05+00:00", datetime(2024, 5, 1, 10, 0, 5)),
        ("2024-05-01T22:00:05-08:00", datetime(2024, 5, 2, 6, 0, 5)),
    ],
)
def test_offsets_and_fractions(spark, text, expected):
    parsed = normalise_trips(trips(spark, trip(start_time=text)))
    row = parsed.select(F.col("start_time").cast("timestamp_ntz"), "trip_date", "trip_hour").first()
    assert row[0] == expected
    assert (row.trip_date, row.trip_hour) == (expected.date(), expected.hour)


def test_seconds_are_cut_before_the_difference(spark, dim):
    events = [
        trip("across", start_time="2024-05-01T10:00:00.900+00:00",
             end_time="2024-05-01T10:00:01.100+00:00"),
        trip("within", start_time="2024-05-01T10:00:00.100+00:00",
             end_time="2024-05-01T10:00:00.900+00:00"),
        trip("backwards", end_time="2024-05-01T09:59:00+00:00"),
    ]
    found = by_id(fact(spark, dim, *events), "trip_duration_minutes", "is_valid_trip")
    assert found == {"ACROSS": (0.02, True), "WITHIN": (0.0, False), "BACKWARDS": (-1.0, False)}


def test_inactive_unknown_and_missing_stations(spark, dim):
    events = [
        trip("inactive", start_station_id="c"),
        trip("unknown", end_station_id="zz"),
        trip("missing", end_station_id=None),
        trip("round", end_station_id="A "),
    ]
    columns = "is_valid_start_station", "is_valid_end_station", "is_round_trip", "is_valid_trip"
    assert by_id(fact(spark, dim, *events), *columns) == {
        "INACTIVE": (False, True, False, False),
        "UNKNOWN": (True, False, False, False),
        "MISSING": (True, False, None, False),
        "ROUND": (True, True, True, True),
    }


def test_station_without_a_name_is_no_hit(spark):
    dim = build_dim_station(stations(spark, ("a", None, "n", True), ("b", "Beta", "n", True)))
    row = fact(spark, dim, trip()).first()
    assert row.start_neighbourhood == "n" and row.is_valid_start_station is False


@pytest.mark.parametrize("budget", [BroadcastBudget(), SHUFFLED])
def test_a_dimension_with_repeated_ids_does_not_multiply_trips(spark, dim, budget):
    facts = fact(spark, dim.unionByName(dim), trip("1"), trip("2"), budget=budget)
    assert by_id(facts, "start_station_name") == {"1": "Alpha", "2": "Alpha"}
    assert facts.count() == 2


def test_empty_trip_id_is_accepted_but_reported(spark, dim):
    facts = fact(spark, dim, trip(" "), trip("x", bike_id=None, end_time=None))
    assert by_id(facts, "is_valid_trip") == {"": True, "X": False}
    report = {(r.severity, r.reason): r.trip_rows for r in reject_reasons(facts).collect()}
    assert report["warning", "trip_id_empty"] == 1
    assert report["reject", "bike_id_missing"] == 1
    assert report["reject", "duration_not_positive"] == 1
    assert sum(report.values()) == 4


def test_latest_version_survives(spark, dim):
    events = [
        trip(user_type="casual", event_created_at="2024-05-01T12:00:00+00:00"),
        trip(user_type="member", event_created_at=None),
        trip(user_type="other", event_created_at="2024-05-01T11:00:00+00:00"),
    ]
    for ordering in (events, events[::-1]):
        assert by_id(fact(spark, dim, *ordering), "user_type") == {"T1": "casual"}


def test_shuffled_lookup_equals_broadcast(spark, dim):
    """A third of the trips at one known station, a third at an unknown one, nulls, a long tail."""
    n = 3000
    number = F.col("id")
    tail = F.concat(F.lit("s"), (number % 700).cast("string"))
    start = (
        F.when(number % 3 == 0, "a").when(number % 3 == 1, "nowhere").otherwise(tail)
    )
    raw = spark.range(n).select(
        F.concat(F.lit("t"), number.cast("string")).alias("trip_id"),
        F.lit("bk").alias("bike_id"),
        F.lit("u").alias("user_id"),
        F.lit("member").alias("user_type"),
        F.lit("classic").alias("bike_type"),
        start.alias("start_station_id"),
        F.when(number % 5 != 0, tail).alias("end_station_id"),
        F.lit("2024-05-01T10:00:00+00:00").alias("start_time"),
        F.lit("2024-05-01T10:10:00+00:00").alias("end_time"),
        F.lit(None).cast("string").alias("event_created_at"),
    )
    names = [("a", "Alpha", "North", True)]
    names += [(f"s{i}", f"Station {i}", "South", i % 4 > 0) for i in range(650)]
    dim = build_dim_station(stations(spark, *names))
    trips_ = normalise_trips(raw)
    assert set(hot_stations(trips_)) == {"A", "NOWHERE"}
    columns = [c for c in FACT_TRIP_COLUMNS if c != "load_dt"]
    broadcast = enrich_trips(trips_, dim).select(*columns)
    shuffled = enrich_trips(trips_, dim, SHUFFLED).select(*columns)
    assert broadcast.count() == shuffled.count() == n
    assert broadcast.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(broadcast).isEmpty()
    # Settled rows must be partitioned by their spread value, not all by the null key.
    physical = shuffled._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(_key#\w+, _spread#\w+", physical)) == 4


def test_budget_measures_the_lookup(spark, dim):
    lookup = active_station_lookup(dim)
    size = payload_bytes(lookup)
    # Two rows: text lengths, an integer, and 8 per column.
    assert size == (1 + 5 + 5 + 8 + 32) + (1 + 4 + 5 + 8 + 32)
    assert BroadcastBudget(size).admits(lookup)
    assert not BroadcastBudget(size - 1).admits(lookup)
    plan = join_stations(normalise_trips(trips(spark, trip())), lookup, SHUFFLED)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in text


def test_join_of_no_trips(spark, dim):
    empty = trips(spark, trip()).limit(0)
    assert build_fact_trip(empty, dim, SHUFFLED).count() == 0
