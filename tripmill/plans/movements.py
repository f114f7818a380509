"""Stations and bikes over time: versions, closures, balances, relocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.asof import as_of
from tripmill.operators.cleaning import has_station_id, normalise_stations
from tripmill.operators.intervals import overlapping
from tripmill.operators.lookup import ROLES, BroadcastBudget
from tripmill.operators.sequence import in_parts, previous_row, running_total
from tripmill.operators.survivors import greatest_first, pick_survivor
from tripmill.operators.validity import valid_trips

# Of two versions of one station and day the greatest by these counts.
VERSION_PRECEDENCE = ("station_name", "neighbourhood", "capacity", "is_active")
# A version without a launch date holds from the first day there is.
ALWAYS = "0001-01-01"


def station_versions(raw: DataFrame) -> DataFrame:
    """Every version of a station in raw station rows: one row per station and launch date."""
    kept = normalise_stations(raw).filter(has_station_id())
    since = F.coalesce("launch_date", F.lit(ALWAYS).cast("date"))
    versions = kept.select("station_id", since.alias("launch_date"), *VERSION_PRECEDENCE)
    return pick_survivor(
        versions, ["station_id", "launch_date"], greatest_first(VERSION_PRECEDENCE)
    )


def trips_as_of(
    trips: DataFrame, versions: DataFrame, budget: BroadcastBudget = BroadcastBudget()
) -> DataFrame:
    """Trips with the station version that held when they began, and when and where they ended.

    `<role>_is_open` tells whether that version was active; a station before its first launch is
    neither known nor open. Nothing is filtered: the fact keeps its own, undated look-up.
    """
    columns = list(trips.columns)
    for role in ROLES:
        own = versions.withColumnRenamed("station_id", f"{role}_station_id")
        trips = as_of(
            trips, own, f"{role}_station_id", f"{role}_time", "launch_date", f"_{role}", budget
        )
    return trips.select(
        *columns,
        *[
            column.alias(f"{role}_{name}")
            for role in ROLES
            for name, column in _version_columns(f"_{role}").items()
        ],
    )


def _version_columns(version: str) -> dict[str, Column]:
    launched = F.col(f"{version}.launch_date").cast("date")
    return {
        "launch_date": F.nullif(launched, F.lit(ALWAYS).cast("date")),
        "station_name": F.col(f"{version}.station_name"),
        "neighbourhood": F.col(f"{version}.neighbourhood"),
        "station_capacity": F.col(f"{version}.capacity"),
        "is_open": F.coalesce(F.col(f"{version}.is_active"), F.lit(False)),
    }


def trip_overlaps(facts: DataFrame) -> DataFrame:
    """Valid trips of one bike that were under way at the same time, each pair once.

    A bike can be on one trip only, so each pair is an error of the records. Of the two the trip with
    the smaller id comes first.
    """
    trips = valid_trips(facts).select("bike_id", "trip_id", "start_time", "end_time")
    span = ("start_time", "end_time")
    ordered = F.col("left.trip_id") < F.col("right.trip_id")
    pairs = overlapping(trips, trips, ["bike_id"], span, span, ordered)
    return pairs.select(
        "left.bike_id",
        "left.trip_id",
        F.col("right.trip_id").alias("other_trip_id"),
        F.greatest("left.start_time", "right.start_time").alias("both_from"),
        F.least("left.end_time", "right.end_time").alias("both_to"),
    )


def trips_in_closures(facts: DataFrame, closures: DataFrame) -> DataFrame:
    """Valid trips under way while their start or end station was closed, and for how many seconds.

    `closures` holds (station_id, closed_from, closed_to); closures of a station may overlap.
    """
    valid = valid_trips(facts)
    visits = valid.select(
        "trip_id",
        "start_time",
        "end_time",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(r).alias("role"), F.col(f"{r}_station_id").alias("station_id"))
                    for r in ROLES
                ]
            )
        ),
    )
    span = ("start_time", "end_time")
    pairs = overlapping(visits, closures, ["station_id"], span, ("closed_from", "closed_to"))
    first = F.greatest("left.start_time", "right.closed_from")
    last = F.least("left.end_time", "right.closed_to")
    micros = F.unix_micros(last) - F.unix_micros(first)
    return pairs.select(
        "left.trip_id",
        "left.role",
        "left.station_id",
        "right.closed_from",
        "right.closed_to",
        F.floor(micros / 1_000_000).alias("closed_seconds"),
    )


def dock_balance(facts: DataFrame) -> DataFrame:
    """Arrivals less departures of each station up to every instant at which one happened.

    A sweep over the ends of valid trips: (station_id, at, departures, arrivals, balance), where
    `balance` counts from 0 before the first trip. One station's instants are summed in as many ranges
    as they need.
    """
    events = valid_trips(facts).select(
        F.inline(
            F.array(
                _event("start_station_id", "start_time", 1, 0),
                _event("end_station_id", "end_time", 0, 1),
            )
        )
    )
    instants = events.groupBy("station_id", "at").agg(
        F.sum("departure").alias("departures"), F.sum("arrival").alias("arrivals")
    )
    order = [F.asc("station_id"), F.asc("at")]
    parted = in_parts(instants, order, "dock-balance")
    change = F.col("arrivals") - F.col("departures")
    total = running_total(parted, ["station_id"], order, change, "balance")
    return total.select("station_id", "at", "departures", "arrivals", "balance")


def _event(station: str, at: str, departure: int, arrival: int) -> Column:
    return F.struct(
        F.col(station).alias("station_id"),
        F.col(at).alias("at"),
        F.lit(departure).cast("long").alias("departure"),
        F.lit(arrival).cast("long").alias("arrival"),
    )


def bikes_under_way(facts: DataFrame) -> DataFrame:
    """Valid trips under way from each instant on at which one begins or ends: (at, under_way)."""
    ends = F.array(
        F.struct(F.col("start_time").alias("at"), F.lit(1).cast("long").alias("change")),
        F.struct(F.col("end_time").alias("at"), F.lit(-1).cast("long").alias("change")),
    )
    instants = valid_trips(facts).select(F.inline(ends)).groupBy("at").agg(
        F.sum("change").alias("change")
    )
    order = [F.asc("at")]
    parted = in_parts(instants, order, "bikes-under-way")
    total = running_total(parted, [], order, F.col("change"), "under_way")
    return total.select("at", "under_way")


def bike_relocations(facts: DataFrame) -> DataFrame:
    """Where a bike's next valid trip begins at another station than its last one ended.

    Trips of a bike follow each other by start, then by id. `idle_seconds` is negative where the
    records overlap. One bike's trips may span many ranges: the last trip of a range is handed on.
    """
    trips = valid_trips(facts).select(
        "bike_id", "start_time", "trip_id", "start_station_id", "end_station_id", "end_time"
    )
    order = [F.asc("bike_id"), F.asc("start_time"), F.asc("trip_id")]
    parted = in_parts(trips, order, "bike-relocations")
    left = F.struct("trip_id", "end_station_id", "end_time")
    rows = previous_row(parted, ["bike_id"], order, left, "previous")
    moved = rows.filter(F.col("previous.end_station_id") != F.col("start_station_id"))
    idle = F.unix_seconds("start_time") - F.unix_seconds("previous.end_time")
    return moved.select(
        "bike_id",
        F.col("previous.trip_id").alias("trip_id"),
        F.col("trip_id").alias("next_trip_id"),
        F.col("previous.end_station_id").alias("left_at"),
        F.col("start_station_id").alias("found_at"),
        idle.alias("idle_seconds"),
    )
