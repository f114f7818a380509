"""De-duplication with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATION_KEY = ["station_id"]
TRIP_KEY = ["trip_id"]

# Latest launch wins; the other columns make the order total.
STATION_PRECEDENCE = [
    "launch_date", "station_name", "neighbourhood", "capacity",
    "latitude", "longitude", "is_active", "file_name",
]

LOOKUP_PRECEDENCE = ["station_name", "neighbourhood", "capacity"]

# Latest version of the event wins; the other columns make the order total.
TRIP_PRECEDENCE = [
    "event_created_at", "start_time", "end_time", "bike_id", "user_id", "user_type",
    "bike_type", "start_station_id", "end_station_id", "file_name",
]


def greatest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in columns]


def pick_survivor(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by `order`.

    `row_number() = 1` is planned with a group limit below the exchange, so each task ships at
    most one row per key: a key that holds a third of all rows costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def surviving_station(stations: DataFrame) -> DataFrame:
    return pick_survivor(stations, STATION_KEY, greatest_first(STATION_PRECEDENCE))


def one_per_station(lookup: DataFrame) -> DataFrame:
    """A lookup that cannot multiply trips, whatever wrote the dimension."""
    return pick_survivor(lookup, STATION_KEY, greatest_first(LOOKUP_PRECEDENCE))


def latest_trip(trips: DataFrame) -> DataFrame:
    """One row per trip id. Rows without a trip id must have been set aside before."""
    return pick_survivor(trips, TRIP_KEY, greatest_first(TRIP_PRECEDENCE))


def keyed(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("trip_id").isNotNull())


def keyless(trips: DataFrame) -> DataFrame:
    """Rows without a trip id: they have no identity, so they are never merged with each other."""
    return trips.filter(F.col("trip_id").isNull())
