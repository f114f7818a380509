"""Normalisation of raw station and trip rows. Narrow transformations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.text import category, identifier, label
from tripmill.functions.times import duration_minutes, instant
from tripmill.session import require_utc

# What `with_derived` adds.
DERIVED = ["trip_date", "trip_hour", "trip_duration_minutes", "is_round_trip"]


def file_name_of(df: DataFrame) -> Column:
    """Source file of each row; null when the rows do not come from a tripmill file reader."""
    if "file_name" in df.columns:
        return F.col("file_name")
    return F.lit(None).cast("string").alias("file_name")


def normalise_stations(raw: DataFrame) -> DataFrame:
    return raw.select(
        identifier("station_id"),
        label("station_name"),
        "latitude",
        "longitude",
        "capacity",
        label("neighbourhood"),
        "is_active",
        "launch_date",
        file_name_of(raw),
    )


def has_station_id() -> Column:
    """False for null and for blank identifiers (the identifier is trimmed already)."""
    return F.coalesce(F.col("station_id") != "", F.lit(False))


def station_reject_reason() -> Column:
    """Why a normalised station row is rejected; null for a row that is kept."""
    return F.when(F.col("station_id").isNull(), "station_id_null").when(
        F.col("station_id") == "", "station_id_blank"
    )


def normalise_trips(raw: DataFrame, *extra: Column) -> DataFrame:
    """Normalised identifiers and categories, parsed instants and the columns derived from them.

    Dates and hours are UTC, so the session must be (`pin_utc`). `extra` columns of
    the raw rows are kept beside them.
    """
    require_utc(raw.sparkSession)
    parsed = raw.select(
        identifier("trip_id"),
        identifier("bike_id"),
        identifier("user_id"),
        category("user_type"),
        category("bike_type"),
        identifier("start_station_id"),
        identifier("end_station_id"),
        instant("start_time"),
        instant("end_time"),
        instant("event_created_at"),
        file_name_of(raw),
        *extra,
    )
    return with_derived(parsed)


def with_derived(parsed: DataFrame) -> DataFrame:
    """Parsed trips with the columns that follow from their instants and stations."""
    start, end = F.col("start_time"), F.col("end_time")
    return parsed.withColumns(
        {
            "trip_date": F.to_date(start),
            "trip_hour": F.hour(start),
            "trip_duration_minutes": duration_minutes(start, end),
            "is_round_trip": F.col("start_station_id") == F.col("end_station_id"),
        }
    )
