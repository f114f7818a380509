"""Event-time windows with late trips, sessions, and the join of departures with arrivals."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tests.helpers import trip, trips
from tripmill.operators.cleaning import normalise_trips
from tripmill.sources.files import land_trips, stream_trip_json
from tripmill.streaming.pairing import by_batch, paired_table, paired_trips
from tripmill.streaming.windows import WindowSink, bike_sessions


def at(hour, minute=0):
    return (datetime(2024, 5, 1) + timedelta(hours=hour, minutes=minute)).isoformat() + "+00:00"


def started(trip_id, hour, minute=0, **changes):
    times = {"start_time": at(hour, minute), "end_time": at(hour, minute + 30)}
    return trip(trip_id, **{**times, **changes})


@pytest.fixture
def sink(tmp_path):
    return WindowSink(str(tmp_path), "2 hours", {"hour": ("1 hour", "1 hour"), "three": ("3 hours", "1 hour")})


def counts(spark, sink, kind):
    own = sink.windows(spark).filter(f"kind = '{kind}' and date(window_start) = '2024-05-01'")
    rows = own.selectExpr("hour(window_start) as hour", "trip_count", "is_closed").collect()
    return {r["hour"]: (r["trip_count"], r["is_closed"]) for r in rows}


def missed(spark, sink):
    return {r["trip_id"]: r["missed"] for r in sink.late.read(spark).collect()}


def test_late_trips_are_set_aside(spark, sink):
    sink(trips(spark, started("1", 3), started("2", 3, 59), started("3", 8)), 0)
    assert counts(spark, sink, "hour") == {3: (2, True), 8: (1, False)}
    assert counts(spark, sink, "three")[3] == (2, True)
    # The watermark is 06:00: hours up to it are closed, of the longer windows those that end by it.
    sink(trips(spark, started("4", 3, 30), started("5", 5), started("6", 6)), 1)
    assert counts(spark, sink, "hour") == {3: (2, True), 6: (1, False), 8: (1, False)}
    assert missed(spark, sink) == {"4": 4, "5": 2}
    three = counts(spark, sink, "three")
    assert three[3] == (2, True) and three[4] == (2, False) and three[5] == (2, False)


def test_a_replayed_batch_changes_nothing(spark, sink):
    batches = [
        [started("1", 3), started("2", 9)],
        [started("3", 1), started("4", 12), started("4", 12)],
        [started("5", 8), started("6", 2)],
    ]
    for number, batch in enumerate(batches):
        sink(trips(spark, *batch), number)
    before = counts(spark, sink, "three"), counts(spark, sink, "hour"), missed(spark, sink)
    for number in (2, 1, 2):
        sink(trips(spark, *batches[number]), number)
    assert (counts(spark, sink, "three"), counts(spark, sink, "hour"), missed(spark, sink)) == before
    assert before[1][12] == (1, False) and set(before[2]) == {"3", "5", "6"}


def test_unreadable_and_far_starts(spark, sink):
    far = trip("far", start_time="12345-01-01T00:00:00Z", end_time=None)
    sink(trips(spark, trip("1", start_time="x"), trip(None), started("2", 1, end_time="y")), 0)
    sink(trips(spark, far), 1)
    sink(trips(spark, started("3", 1)), 2)
    assert counts(spark, sink, "hour") == {1: (1, True)}
    assert missed(spark, sink) == {"3": 4}
    empty = trips(spark, trip(None)).filter("false")
    sink(empty, 3)
    assert counts(spark, sink, "hour") == {1: (1, True)}


def test_sessions_of_a_table(spark):
    made = [started(str(i), h, bike_id=b) for i, (h, b) in enumerate(
        [(1, "x"), (2, "x"), (7, "x"), (1, "y"), (5, "y"), (9, None), (10, "y")])]
    rows = bike_sessions(normalise_trips(trips(spark, *made)), "4 hours").collect()
    found = sorted((r["bike_id"], r["session_start"].hour, r["session_end"].hour, r["trip_count"]) for r in rows)
    assert found == [("X", 1, 6, 2), ("X", 7, 11, 1), ("Y", 1, 9, 2), ("Y", 10, 14, 1)]


def departed(trip_id, hour, **changes):
    return trip(trip_id, **{"start_time": at(hour), "end_time": None, "end_station_id": None, **changes})


def arrived(trip_id, hour, **changes):
    return trip(trip_id, **{"start_time": None, "end_time": at(hour), "start_station_id": None, **changes})


DEPARTURES = [departed("1", 1), departed("1", 1), departed("2", 1), departed("3", 1), departed(None, 1),
              departed("4", 1, start_time="x"), departed("5", 5)]
ARRIVALS = [arrived("1", 2), arrived("1", 2), arrived("2", 30), arrived("3", 0), arrived(None, 2),
            arrived("5", 5), arrived("6", 1), arrived("4", 2)]
STATUS = [("1", "ended"), ("2", "open"), ("3", "open"), ("4", "unusable"), ("5", "ended"), (None, "unusable")]


def test_pairs_of_tables(spark):
    rows = paired_trips(trips(spark, *DEPARTURES), trips(spark, *ARRIVALS)).collect()
    assert sorted(((r["trip_id"], r["status"]) for r in rows), key=repr) == sorted(STATUS, key=repr)
    assert {r["trip_id"] for r in rows if r["end_time"]} == {"1", "5"}


def test_pairs_of_streams_over_batches(spark, tmp_path):
    """A departure waits for its arrival over batches, and comes out open once its time is up."""
    target = paired_table(f"{tmp_path}/paired")

    def run(departures, arrivals):
        for side, rows in (("d", departures), ("a", arrivals)):
            if rows:
                land_trips(trips(spark, *rows), f"{tmp_path}/{side}")
        sides = [stream_trip_json(spark, f"{tmp_path}/{side}") for side in "da"]
        query = paired_trips(*sides).writeStream.foreachBatch(by_batch(target))
        query = query.option("checkpointLocation", f"{tmp_path}/checkpoint").outputMode("append")
        query.trigger(availableNow=True).start().awaitTermination()
        found = target.read(spark).collect()
        return sorted(((r["trip_id"], r["status"]) for r in found), key=repr)

    early = [a for a in ARRIVALS if a["trip_id"] in ("3", "6", None)]
    assert run(DEPARTURES, early) == sorted([("4", "unusable"), (None, "unusable")], key=repr)
    rest = [a for a in ARRIVALS if a not in early]
    first = run([], rest)
    assert ("1", "ended") in first and ("5", "ended") in first and ("2", "open") not in first
    far = run([departed("FAR", 900)], [arrived("FAR2", 900)])
    assert far == sorted(STATUS, key=repr)


def test_a_batch_keeps_only_what_it_counts(spark, tmp_path, monkeypatch):
    kept, placed = [], WindowSink._placed
    monkeypatch.setattr(
        WindowSink, "_placed", lambda sink, df: kept.append(set(df.columns)) or placed(sink, df)
    )
    WindowSink(str(tmp_path / "windows"))(trips(spark, trip()), 0)
    assert kept == [
        {"trip_id", "bike_id", "bike_type", "start_time", "end_time", "trip_duration_minutes"}
    ]
