"""The business questions. Each reads a mart, or the fact where no mart holds the column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.numbers import exact_mean, hundredths, ratio_4dp
from tripmill.operators.validity import valid_trips


def trips_per_day(hourly: DataFrame) -> DataFrame:
    """How many trips happened each day?"""
    return hourly.groupBy("trip_date").agg(F.sum("trip_count").alias("trips"))


def busiest_stations(daily: DataFrame, k: int = 10) -> DataFrame:
    """Which stations are busiest? The k stations with most departures plus arrivals."""
    return (
        _station_totals(daily)
        .withColumn("trips", F.col("trip_starts") + F.col("trip_ends"))
        .orderBy(F.desc("trips"), "station_id")
        .limit(k)
    )


def net_arrival_stations(daily: DataFrame) -> DataFrame:
    """Which stations have more arrivals than departures?"""
    return (
        _station_totals(daily)
        .withColumn("net_outflow", F.col("trip_starts") - F.col("trip_ends"))
        .filter(F.col("net_outflow") < 0)
    )


def top_od_pairs(od: DataFrame, k: int = 10) -> DataFrame:
    """What are the most common origin-destination pairs?"""
    return (
        od.groupBy("start_station_id", "end_station_id")
        .agg(F.sum("trip_count").alias("trips"))
        .orderBy(F.desc("trips"), "start_station_id", "end_station_id")
        .limit(k)
    )


def bike_usage(facts: DataFrame) -> DataFrame:
    """How often are bikes used? Trips, days in use and minutes ridden per bike."""
    return (
        valid_trips(facts)
        .groupBy("bike_id")
        .agg(
            F.count("*").alias("trips"),
            F.count_distinct("trip_date").alias("active_days"),
            (F.sum(hundredths(F.col("trip_duration_minutes"))) / F.lit(100.0)).alias("minutes"),
        )
    )


def bike_type_comparison(facts: DataFrame) -> DataFrame:
    """How do e-bikes compare with classic bikes?

    The total is summed over the one row of each type, so the fact is read once.
    """
    by_type = (
        valid_trips(facts)
        .groupBy("bike_type")
        .agg(
            F.count("*").alias("trips"),
            exact_mean(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
            F.count_if(F.col("is_round_trip")).alias("round_trips"),
        )
    )
    total = F.sum("trips").over(Window.partitionBy())
    return by_type.select(
        "bike_type",
        "trips",
        ratio_4dp(F.col("trips"), total).alias("trip_share"),
        "avg_trip_duration_minutes",
        "round_trips",
        ratio_4dp(F.col("round_trips"), F.col("trips")).alias("round_trip_rate"),
    )


def trips_over_midnight(facts: DataFrame) -> DataFrame:
    """How many trips arrive on another date than the one they are counted on?

    Marts date arrivals by the start; `days_later` tells by how many days that is too early.
    """
    later = F.date_diff(F.to_date("end_time"), F.col("trip_date"))
    return (
        valid_trips(facts)
        .withColumn("days_later", later)
        .filter("days_later > 0")
        .groupBy("trip_date", "days_later")
        .agg(F.count("*").alias("trip_count"))
    )


def _station_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("station_id").agg(
        F.sum("trip_starts").alias("trip_starts"), F.sum("trip_ends").alias("trip_ends")
    )
