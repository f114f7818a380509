"""Validity of a trip as a set of named rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validity_rules() -> dict[str, Column]:
    """What a valid trip satisfies, by the name under which a failure is reported.

    A rule never yields null: an unknown duration fails its rule like a non-positive one.
    """
    return {
        "trip_id_missing": F.col("trip_id").isNotNull(),
        "bike_id_missing": F.col("bike_id").isNotNull(),
        "start_time_missing": F.col("start_time").isNotNull(),
        "end_time_missing": F.col("end_time").isNotNull(),
        "duration_not_positive": F.coalesce(F.col("trip_duration_minutes") > 0, F.lit(False)),
        "start_station_unknown": F.col("is_valid_start_station"),
        "end_station_unknown": F.col("is_valid_end_station"),
    }


def flag_validity(joined: DataFrame) -> DataFrame:
    """Station hit flags and the overall flag. Invalid rows stay; marts filter them."""
    hits = joined.withColumns(
        {
            f"is_valid_{role}_station": F.coalesce(F.col(f"{role}_known"), F.lit(False))
            for role in ("start", "end")
        }
    )
    all_hold = reduce(lambda left, right: left & right, validity_rules().values())
    return hits.withColumn("is_valid_trip", all_hold).drop("start_known", "end_known")


def reject_reasons(facts: DataFrame) -> DataFrame:
    """Rows failing each rule (a row may fail several), plus accepted rows worth a look.

    One global aggregate over the facts; `severity` tells rejects from warnings.
    """
    counts = {
        name: ("reject", F.count_if(~rule)) for name, rule in validity_rules().items()
    }
    counts["trip_id_empty"] = ("warning", F.count_if(F.col("trip_id") == ""))
    totals = facts.agg(*[count.alias(name) for name, (_, count) in counts.items()])
    lines = [
        F.struct(
            F.lit(name).alias("reason"),
            F.lit(severity).alias("severity"),
            F.col(name).alias("trip_rows"),
        )
        for name, (severity, _) in counts.items()
    ]
    return totals.select(F.inline(F.array(*lines)))


def valid_trips(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("is_valid_trip"))
