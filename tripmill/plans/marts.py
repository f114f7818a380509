"""The gold marts, each a function of the trip fact, and their registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import exact_mean, hundredths, mean_2dp
from tripmill.operators.validity import valid_trips


def hourly_demand(facts: DataFrame) -> DataFrame:
    """Demand by date, hour, start neighbourhood, bike type and user type.

    Two exact distinct counts in one grouping are planned as an expand and two exchanges. The
    first exchange is keyed by the group and the distinct value, so a hot group is spread over
    its bikes and users before its counts meet.
    """
    return (
        valid_trips(facts)
        .groupBy("trip_date", "trip_hour", "start_neighbourhood", "bike_type", "user_type")
        .agg(
            F.count("*").alias("trip_count"),
            F.count_distinct("bike_id").alias("active_bikes"),
            F.count_distinct("user_id").alias("active_users"),
            exact_mean(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
            F.sum(F.when(F.col("is_round_trip"), 1).otherwise(0)).alias("round_trip_count"),
        )
        .withColumn("mart_load_dt", F.current_timestamp())
    )


def station_od(facts: DataFrame) -> DataFrame:
    """Trips by date, origin, destination, bike type and user type."""
    return (
        valid_trips(facts)
        .groupBy(
            "trip_date",
            *[
                f"{role}_{column}"
                for role in ("start", "end")
                for column in ("station_id", "station_name", "neighbourhood")
            ],
            "bike_type",
            "user_type",
        )
        .agg(
            F.count("*").alias("trip_count"),
            exact_mean(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
        )
        .withColumn("mart_load_dt", F.current_timestamp())
    )


def station_daily_activity(facts: DataFrame, single_scan: bool = False) -> DataFrame:
    """Departures and arrivals by date and station. Arrivals count on the trip's start date.

    The default joins the two aggregates. Each side reads only its own role's columns of a
    columnar fact, and what is shuffled is aggregated already, so reading the fact twice costs
    little more than reading it once. `single_scan` reads it once, which pays when the fact is
    computed rather than stored; it gives the same rows as long as no station changes its name
    or neighbourhood within a date (`unique_audit` on the default form tells).
    """
    valid = valid_trips(facts)
    activity = _single_scan_activity(valid) if single_scan else _joined_activity(valid)
    return activity.withColumn("mart_load_dt", F.current_timestamp())


def _joined_activity(valid: DataFrame) -> DataFrame:
    starts = _role_activity(valid, "start", "trip_starts").alias("s")
    ends = _role_activity(valid, "end", "trip_ends").alias("e")
    on = [F.col(f"s.{key}") == F.col(f"e.{key}") for key in ("trip_date", "station_id")]
    departures = F.coalesce("s.trip_starts", F.lit(0))
    arrivals = F.coalesce("e.trip_ends", F.lit(0))
    return starts.join(ends, on, "full_outer").select(
        *[
            F.coalesce(f"s.{column}", f"e.{column}").alias(column)
            for column in ("trip_date", "station_id", "station_name", "neighbourhood")
        ],
        departures.alias("trip_starts"),
        arrivals.alias("trip_ends"),
        (departures - arrivals).alias("net_outflow"),
        "avg_start_trip_duration_minutes",
        "avg_end_trip_duration_minutes",
    )


def _role_activity(valid: DataFrame, role: str, count_name: str) -> DataFrame:
    return valid.groupBy(
        "trip_date",
        F.col(f"{role}_station_id").alias("station_id"),
        F.col(f"{role}_station_name").alias("station_name"),
        F.col(f"{role}_neighbourhood").alias("neighbourhood"),
    ).agg(
        F.count("*").alias(count_name),
        exact_mean(F.col("trip_duration_minutes")).alias(f"avg_{role}_trip_duration_minutes"),
    )


def _single_scan_activity(valid: DataFrame) -> DataFrame:
    def visit(role: str):
        return F.struct(
            F.lit(role == "start").alias("departs"),
            F.col(f"{role}_station_id").alias("station_id"),
            F.col(f"{role}_station_name").alias("station_name"),
            F.col(f"{role}_neighbourhood").alias("neighbourhood"),
        )

    visits = valid.select(
        "trip_date",
        hundredths(F.col("trip_duration_minutes")).alias("duration"),
        F.inline(F.array(visit("start"), visit("end"))),
    )
    departs = F.col("departs")
    totals = visits.groupBy("trip_date", "station_id", "station_name", "neighbourhood").agg(
        F.count_if(departs).alias("trip_starts"),
        F.count_if(~departs).alias("trip_ends"),
        F.sum(F.when(departs, F.col("duration"))).alias("start_duration"),
        F.sum(F.when(~departs, F.col("duration"))).alias("end_duration"),
    )
    return totals.select(
        "trip_date",
        "station_id",
        "station_name",
        "neighbourhood",
        "trip_starts",
        "trip_ends",
        (F.col("trip_starts") - F.col("trip_ends")).alias("net_outflow"),
        mean_2dp(F.col("start_duration"), F.col("trip_starts")).alias(
            "avg_start_trip_duration_minutes"
        ),
        mean_2dp(F.col("end_duration"), F.col("trip_ends")).alias("avg_end_trip_duration_minutes"),
    )


@dataclass(frozen=True)
class Mart:
    """A gold table: how it is built, what it is tagged with, which columns may not be null."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    tags: frozenset[str]
    non_null: tuple[str, ...]
    schema: str


# Names, tags and audited columns are fixed values.
MARTS = {
    mart.name: mart
    for mart in (
        Mart(
            "mart_hourly_demand",
            hourly_demand,
            frozenset({"gold", "hourly", "demand"}),
            ("trip_date", "trip_hour"),
            """trip_date DATE, trip_hour INT, start_neighbourhood STRING, bike_type STRING,
            user_type STRING, trip_count BIGINT, active_bikes BIGINT, active_users BIGINT,
            avg_trip_duration_minutes DOUBLE, round_trip_count BIGINT, mart_load_dt TIMESTAMP""",
        ),
        Mart(
            "mart_station_daily_activity",
            station_daily_activity,
            frozenset({"gold", "station", "daily"}),
            ("trip_date", "station_id"),
            """trip_date DATE, station_id STRING, station_name STRING, neighbourhood STRING,
            trip_starts BIGINT, trip_ends BIGINT, net_outflow BIGINT,
            avg_start_trip_duration_minutes DOUBLE, avg_end_trip_duration_minutes DOUBLE,
            mart_load_dt TIMESTAMP""",
        ),
        Mart(
            "mart_station_od",
            station_od,
            frozenset({"gold", "od", "station"}),
            ("trip_date", "start_station_id", "end_station_id"),
            """trip_date DATE, start_station_id STRING, start_station_name STRING,
            start_neighbourhood STRING, end_station_id STRING, end_station_name STRING,
            end_neighbourhood STRING, bike_type STRING, user_type STRING, trip_count BIGINT,
            avg_trip_duration_minutes DOUBLE, mart_load_dt TIMESTAMP""",
        ),
    )
}


def marts_tagged(tags: Iterable[str] = ("gold",)) -> list[Mart]:
    """Marts that carry at least one of the tags."""
    wanted = set(tags)
    return [mart for mart in MARTS.values() if mart.tags & wanted]
