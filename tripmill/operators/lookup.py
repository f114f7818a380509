"""Left joins of trips to the station dimension, in its start and end role.

Two physical forms with the same result:

* the lookup fits the broadcast budget (its payload is measured, not guessed): two broadcast
  hash joins, no shuffle of the trips;
* it does not: trips shuffle to the lookup. Station ids that hold a large share of the trips are
  settled by a broadcast of just those rows, and every row that is settled or has no id is
  spread over the partitions, so no task receives one id's whole share.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = ("start", "end")

# A station counts as hot when it has more than this share of all start and end visits,
# so there are fewer than 1 / share hot stations.
HOT_SHARE = 1 / 512
# How many hash values settled rows are spread over.
SPREAD = 1 << 20


@dataclass(frozen=True)
class BroadcastBudget:
    """How many payload bytes one broadcast may hold, and a size already proven, if any.

    `hot_share` is the share of all visits above which a station counts as hot when the lookup is
    beyond the limit.
    """

    limit_bytes: int = 64 << 20
    known_bytes: int | None = None
    hot_share: float = HOT_SHARE

    def measured(self, df: DataFrame) -> BroadcastBudget:
        """The budget with the size that is proven, or else that of `df`."""
        known = payload_bytes(df) if self.known_bytes is None else self.known_bytes
        return replace(self, known_bytes=known)

    def admits(self, df: DataFrame) -> bool:
        return self.measured(df).known_bytes <= self.limit_bytes


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of one row: text length or fixed width, plus 8 per column."""
    widths = [
        F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        if isinstance(field.dataType, T.StringType)
        else F.lit(8)
        for field in df.schema.fields
    ]
    return sum(widths, F.lit(8 * len(widths)))


def payload_bytes(df: DataFrame) -> int:
    """Measured size of a whole DataFrame: one distributed sum, one number to the driver."""
    return df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0


def active_station_lookup(stations: DataFrame) -> DataFrame:
    """The four lookup columns of active stations; unknown activity counts as inactive."""
    return stations.filter(F.col("is_active")).select(
        "station_id", "station_name", "neighbourhood", "capacity"
    )


def station_role(lookup: DataFrame, role: str) -> DataFrame:
    """The lookup under the column names of one role.

    `<role>_known` marks a hit. A station without a name is not a usable hit.
    """
    return lookup.select(
        F.col("station_id").alias(f"{role}_station_id"),
        F.col("station_name").alias(f"{role}_station_name"),
        F.col("neighbourhood").alias(f"{role}_neighbourhood"),
        F.col("capacity").alias(f"{role}_station_capacity"),
        F.col("station_name").isNotNull().alias(f"{role}_known"),
    )


def join_stations(
    trips: DataFrame,
    lookup: DataFrame,
    budget: BroadcastBudget = BroadcastBudget(),
    visits: DataFrame | None = None,
) -> DataFrame:
    """Add the start and end station columns to every trip; trips without a hit get nulls.

    `visits` may name a cheaper DataFrame with the same station id columns (for example the trips
    before a shuffle) from which hot stations are found when the lookup has to be shuffled.
    """
    if budget.admits(lookup):
        for role in ROLES:
            side = F.broadcast(station_role(lookup, role))
            trips = trips.join(side, f"{role}_station_id", "left")
        return trips
    hot = hot_stations(trips if visits is None else visits, budget.hot_share)
    for role in ROLES:
        trips = _shuffled_role_join(trips, lookup, role, hot)
    return trips


def hot_stations(trips: DataFrame, share: float = HOT_SHARE) -> list[str]:
    """Station ids with more than `share` of all visits: fewer than 1 / share strings.

    One pass over the trips: the counts of the stations, null included, are kept for the total.
    """
    ids = F.explode(F.array(*[F.col(f"{role}_station_id") for role in ROLES]))
    counts = trips.select(ids.alias("station_id")).groupBy("station_id")
    counts = counts.agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = counts.agg(F.sum("n")).first()[0] or 0
        hot = counts.filter(F.col("station_id").isNotNull() & (F.col("n") > total * share))
        return [row["station_id"] for row in hot.select("station_id").collect()]
    finally:
        counts.unpersist()


def _shuffled_role_join(
    trips: DataFrame, lookup: DataFrame, role: str, hot: list[str]
) -> DataFrame:
    key = f"{role}_station_id"
    side = station_role(lookup, role)
    payload = [name for name in side.columns if name != key]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)

    hot_side = side.filter(is_hot).select(key, *[F.col(c).alias(f"_hot_{c}") for c in payload])
    # Always 0, but not a literal: a constant key would be optimised out of the partitioning.
    zero = F.col(key).isNull().cast("long")
    cold_side = side.filter(~is_hot).select(
        F.col(key).alias("_key"),
        zero.alias("_spread"),
        *[F.col(c).alias(f"_cold_{c}") for c in payload],
    )
    settled = F.col(key).isNull() | is_hot
    scattered = F.pmod(F.xxhash64(*[F.col(c) for c in trips.columns]), F.lit(SPREAD))
    keyed = (
        trips.join(F.broadcast(hot_side), key, "left")
        .withColumn("_key", F.when(~settled, F.col(key)))
        .withColumn("_spread", F.when(settled, scattered).otherwise(F.lit(0).cast("long")))
    )
    joined = keyed.join(cold_side.hint("merge"), ["_key", "_spread"], "left")
    merged = [F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in payload]
    return joined.select(*trips.columns, *merged)
