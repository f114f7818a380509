"""Small tables for the tests."""

from __future__ import annotations

import json

from tripmill.schemas import STATION_CSV, TRIP_COLUMNS, TRIP_JSON

STATION_HEADER = (
    "station_id,station_name,latitude,longitude,capacity,neighbourhood,is_active,launch_date"
)


def stations(spark, *rows):
    """Station rows given as (id, name, neighbourhood, active)."""
    full = [
        (station_id, name, 49.0, -123.0, 20, neighbourhood, active, None)
        for station_id, name, neighbourhood, active in rows
    ]
    return spark.createDataFrame(full, STATION_CSV)


def trip(trip_id="t1", **changes):
    """One valid raw trip from A to B, with changes."""
    event = {
        "trip_id": trip_id,
        "bike_id": "bk1",
        "user_id": "u1",
        "user_type": "member",
        "bike_type": "classic",
        "start_station_id": "a",
        "end_station_id": "b",
        "start_time": "2024-05-01T10:00:00+00:00",
        "end_time": "2024-05-01T10:30:00+00:00",
        "event_created_at": "2024-05-01T10:30:05+00:00",
    }
    return {**event, **changes}


def trips(spark, *events):
    return spark.createDataFrame([[e[c] for c in TRIP_COLUMNS] for e in events], TRIP_JSON)


def land(directory, day, name, *lines):
    """A landed file; events are written as JSON, text as it is."""
    folder = directory / f"ingest_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / f"trip_events_{name}.jsonl").write_text("\n".join(texts))


def two_stations(spark):
    return stations(
        spark, ("a", "Alpha", "North", True), ("b", "Beta", "South", True),
        ("c", "Closed", "South", False),
    )


def by_id(df, *columns):
    rows = df.select("trip_id", *columns).collect()
    return {row[0]: row[1] if len(columns) == 1 else tuple(row)[1:] for row in rows}
