"""Balances, relocations and closures of a few trips; one bike and station hold most of them."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tests.helpers import trip, trips, two_stations
from tripmill.plans import movements
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip


def at(minute):
    return (datetime(2024, 5, 1) + timedelta(minutes=minute)).isoformat() + "+00:00"


def facts_of(spark, *made):
    """Valid trips from (id, bike, from, to, start minute, end minute)."""
    events = [
        trip(i, bike_id=bike, start_station_id=a, end_station_id=b, start_time=at(s), end_time=at(e))
        for i, bike, a, b, s, e in made
    ]
    return build_fact_trip(trips(spark, *events), build_dim_station(two_stations(spark)))


@pytest.fixture(scope="module")
def facts(spark):
    return facts_of(
        spark,
        ("t1", "x", "a", "b", 0, 10),
        ("t2", "x", "b", "a", 10, 20),
        ("t3", "x", "b", "b", 15, 40),
        ("t4", "y", "a", "a", 5, 10),
        ("t5", "y", "b", "c", 50, 60),
        ("t6", "y", "b", "a", 55, 50),
    )


def test_overlaps(facts):
    got = [(r["trip_id"], r["other_trip_id"]) for r in movements.trip_overlaps(facts).collect()]
    assert got == [("T2", "T3")]


def test_balance(facts):
    rows = movements.dock_balance(facts).orderBy("station_id", "at").collect()
    found = [(r["station_id"], r["at"].minute, r["departures"], r["arrivals"], r["balance"]) for r in rows]
    assert found == [
        ("A", 0, 1, 0, -1), ("A", 5, 1, 0, -2), ("A", 10, 0, 1, -1), ("A", 20, 0, 1, 0),
        ("B", 10, 1, 1, 0), ("B", 15, 1, 0, -1), ("B", 40, 0, 1, 0),
    ]


def test_under_way(facts):
    rows = movements.bikes_under_way(facts).orderBy("at").collect()
    assert [(r["at"].minute, r["under_way"]) for r in rows] == [
        (0, 1), (5, 2), (10, 1), (15, 2), (20, 1), (40, 0)
    ]


def test_relocations(facts):
    rows = movements.bike_relocations(facts).collect()
    assert [(r["trip_id"], r["next_trip_id"], r["left_at"], r["found_at"], r["idle_seconds"])
            for r in rows] == [("T2", "T3", "A", "B", -300)]


def test_a_bike_over_many_ranges(spark, monkeypatch):
    plain_parts = movements.in_parts
    monkeypatch.setattr(
        movements, "in_parts", lambda df, order, purpose: plain_parts(df, order, purpose, 6)
    )
    ends = ["ab", "ba", "aa", "ba", "ab"]
    made = [(f"t{i:03}", "x", *ends[i % 5], 10 * i, 10 * i + 5) for i in range(200)]
    facts = facts_of(spark, *made).cache()
    moved = {r["next_trip_id"] for r in movements.bike_relocations(facts).collect()}
    wanted = {b[0].upper() for a, b in zip(made, made[1:]) if a[3] != b[2]}
    assert moved == wanted and len(wanted) > 50
    last = movements.dock_balance(facts).orderBy("station_id", "at").collect()[-1]
    arrivals = sum(t[3] == "b" for t in made) - sum(t[2] == "b" for t in made)
    assert (last["station_id"], last["balance"]) == ("B", arrivals)


def test_closures(spark, facts):
    day = datetime(2024, 5, 1)
    closures = spark.createDataFrame(
        [("A", day + timedelta(minutes=8), day + timedelta(minutes=12)),
         ("A", day + timedelta(minutes=20), day + timedelta(days=300)), ("Q", day, day)],
        "station_id string, closed_from timestamp, closed_to timestamp",
    )
    found = movements.trips_in_closures(facts, closures).collect()
    assert sorted((r["trip_id"], r["role"], r["closed_seconds"]) for r in found) == [
        ("T1", "start", 120), ("T2", "end", 120), ("T4", "end", 120), ("T4", "start", 120)
    ]


def test_no_trips(spark, facts):
    none = facts.filter("false")
    for build in (movements.trip_overlaps, movements.dock_balance, movements.bikes_under_way,
                  movements.bike_relocations):
        assert build(none).count() == 0
