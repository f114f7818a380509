"""Demand at several grains at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import exact_mean
from tripmill.operators.validity import valid_trips

DIMENSIONS = ("start_neighbourhood", "bike_type", "user_type")
CALENDAR = ("trip_date", "trip_hour")


def demand_cube(facts: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Demand for every subset of the dimensions."""
    valid = valid_trips(facts)
    return _measured(valid.cube(*dimensions), dimensions)


def demand_rollup(facts: DataFrame, dimensions: Sequence[str] = CALENDAR) -> DataFrame:
    """Demand for every leading part of the dimensions: by hour, by day and in all."""
    return _measured(valid_trips(facts).rollup(*dimensions), dimensions)


def demand_grouping_sets(
    facts: DataFrame, sets: Sequence[Sequence[str]], dimensions: Sequence[str]
) -> DataFrame:
    """Demand for the given sets of the dimensions alone."""
    named = [[F.col(name) for name in one] for one in sets]
    grouped = valid_trips(facts).groupingSets(named, *[F.col(name) for name in dimensions])
    return _measured(grouped, dimensions)


def _measured(grouped, dimensions: Sequence[str]) -> DataFrame:
    """The dimensions, `<dimension>_is_all`, `grouping_level` and the measures of demand.

    A null in a dimension is a group of its own unless `<dimension>_is_all` says that the row is for
    all its values. `grouping_level` has a bit for each dimension, the last one's lowest. Distinct
    counts are exact at every level: one expansion makes a row for each grouping set, and the
    distinct values meet under their group and value first, so the group of all trips is spread, too.
    """
    measured = grouped.agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.count("*").alias("trip_count"),
        F.count_distinct("bike_id").alias("active_bikes"),
        F.count_distinct("user_id").alias("active_users"),
        exact_mean(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
    )
    last = len(dimensions) - 1
    marks = [
        (F.shiftright("grouping_level", last - i).bitwiseAND(F.lit(1)) == 1).alias(f"{name}_is_all")
        for i, name in enumerate(dimensions)
    ]
    measures = ("trip_count", "active_bikes", "active_users", "avg_trip_duration_minutes")
    return measured.select(*dimensions, *marks, "grouping_level", *measures)
