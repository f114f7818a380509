"""A mart of mergeable sketches: distinct bikes and users, and durations, at any grain.

Exact distinct counts do not add up over dates or stations, so a coarser report has to read the trips
again. Sketches do: each load writes the sketches of its own trips, and every report merges what is
stored. The fact is not read again, neither by a load nor by a report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import hundredths
from tripmill.operators.validity import valid_trips
from tripmill.sources.tables import PartitionedTable, rebalanced

GRAIN = ("trip_date", "trip_hour", "start_neighbourhood", "bike_type", "user_type")
LOAD = "load_batch"
# Distinct counts are exact up to about 2 ** this and then have a relative standard error of
# 1 / sqrt(2 ** this); a quantile's rank is off by about 1.65 % of the trips at this k.
THETA_LG_ENTRIES, KLL_K = 12, 200
SCHEMA = f"""
    trip_date DATE, trip_hour INT, start_neighbourhood STRING, bike_type STRING, user_type STRING,
    trip_count BIGINT, bikes BINARY, users BINARY, durations BINARY, {LOAD} STRING
"""


def sketch_table(path: str) -> PartitionedTable:
    """Sketches by load: writing a load again replaces what it has written before."""
    return PartitionedTable(path, SCHEMA, (LOAD,))


def trip_sketches(facts: DataFrame) -> DataFrame:
    """One row of sketches for each group of the grain that has valid trips."""
    return (
        valid_trips(facts)
        .groupBy(*GRAIN)
        .agg(
            F.count("*").alias("trip_count"),
            F.theta_sketch_agg("bike_id", F.lit(THETA_LG_ENTRIES)).alias("bikes"),
            F.theta_sketch_agg("user_id", F.lit(THETA_LG_ENTRIES)).alias("users"),
            F.kll_sketch_agg_bigint(
                hundredths(F.col("trip_duration_minutes")), F.lit(KLL_K)
            ).alias("durations"),
        )
    )


def add_load(table: PartitionedTable, facts: DataFrame, load: str) -> None:
    """Stores the sketches of a load's trips. Trips that a later version replaces stay counted."""
    rows = trip_sketches(facts).withColumn(LOAD, F.lit(load))
    table.replace_partitions(rebalanced(rows, LOAD))


def merged(sketches: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Stored sketches merged to any part of the grain; no columns at all make one row of them."""
    return sketches.groupBy(*grain).agg(
        F.sum("trip_count").alias("trip_count"),
        F.theta_union_agg("bikes", F.lit(THETA_LG_ENTRIES)).alias("bikes"),
        F.theta_union_agg("users", F.lit(THETA_LG_ENTRIES)).alias("users"),
        F.kll_merge_agg_bigint("durations", F.lit(KLL_K)).alias("durations"),
    )


def estimated(sketches: DataFrame, ranks: Sequence[float] = (0.0, 0.5, 0.9, 1.0)) -> DataFrame:
    """Sketches as numbers: distinct bikes and users, and minutes at the given ranks.

    The least and the greatest duration are exact.
    """
    kept = [c for c in sketches.columns if c not in ("bikes", "users", "durations")]
    found = F.kll_sketch_get_quantile_bigint("durations", F.array(*[F.lit(r) for r in ranks]))
    return sketches.select(
        *kept,
        F.theta_sketch_estimate("bikes").alias("active_bikes"),
        F.theta_sketch_estimate("users").alias("active_users"),
        F.transform(found, lambda x: x / F.lit(100.0)).alias("duration_quantiles"),
    )


def returning(sketches: DataFrame, of: str, earlier: str, later: str) -> DataFrame:
    """Distinct `of` (bikes or users) seen both before a date and from another one on: (both, gone).

    `gone` were seen before `earlier` and not from `later` on.
    """
    def united(chosen):
        return F.theta_union_agg(F.when(chosen, F.col(of)), F.lit(THETA_LG_ENTRIES))

    date = F.col("trip_date")
    sides = sketches.agg(
        united(date < F.lit(earlier).cast("date")).alias("a"),
        united(date >= F.lit(later).cast("date")).alias("b"),
    )
    return sides.select(
        F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("both"),
        F.theta_sketch_estimate(F.theta_difference("a", "b")).alias("gone"),
    )
