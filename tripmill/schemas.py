"""Row schemas of the station-trip model, as Spark DDL.

Every read states its schema; nothing is inferred. Column names and types are fixed values:
the files and tables of the model are exchanged under exactly these names.
"""

from __future__ import annotations

STATION_CSV = """
    station_id STRING, station_name STRING, latitude DOUBLE, longitude DOUBLE,
    capacity INT, neighbourhood STRING, is_active BOOLEAN, launch_date DATE
"""

TRIP_JSON = """
    trip_id STRING, bike_id STRING, user_id STRING, user_type STRING, bike_type STRING,
    start_station_id STRING, end_station_id STRING,
    start_time STRING, end_time STRING, event_created_at STRING
"""

DIM_STATION = """
    station_key STRING, station_id STRING, station_name STRING,
    latitude DOUBLE, longitude DOUBLE, capacity INT, neighbourhood STRING,
    is_active BOOLEAN, launch_date DATE, load_dt TIMESTAMP, file_name STRING
"""

FACT_TRIP = """
    trip_id STRING, bike_id STRING, user_id STRING, user_type STRING, bike_type STRING,
    start_station_id STRING, start_station_name STRING,
    start_neighbourhood STRING, start_station_capacity INT,
    end_station_id STRING, end_station_name STRING,
    end_neighbourhood STRING, end_station_capacity INT,
    start_time TIMESTAMP, end_time TIMESTAMP,
    trip_date DATE, trip_hour INT, trip_duration_minutes DOUBLE, is_round_trip BOOLEAN,
    is_valid_start_station BOOLEAN, is_valid_end_station BOOLEAN, is_valid_trip BOOLEAN,
    event_created_at TIMESTAMP, load_dt TIMESTAMP, file_name STRING
"""


def columns(ddl: str) -> list[str]:
    """Column names of a DDL string, in order."""
    return [field.split()[0] for field in ddl.split(",")]


STATION_COLUMNS = columns(STATION_CSV)
TRIP_COLUMNS = columns(TRIP_JSON)
DIM_STATION_COLUMNS = columns(DIM_STATION)
FACT_TRIP_COLUMNS = columns(FACT_TRIP)
