"""The trip fact: normalised, de-duplicated, enriched and flagged trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.cleaning import DERIVED, normalise_trips, with_derived
from tripmill.operators.lookup import BroadcastBudget, active_station_lookup, join_stations
from tripmill.operators.survivors import keyed, latest_trip, one_per_station
from tripmill.operators.validity import flag_validity
from tripmill.schemas import FACT_TRIP_COLUMNS
from tripmill.sources.tables import rebalanced


def enrich_trips(
    trips: DataFrame,
    stations: DataFrame,
    budget: BroadcastBudget = BroadcastBudget(),
    visits: DataFrame | None = None,
    write_by: Sequence[str] = (),
) -> DataFrame:
    """Normalised trips to fact rows: both station roles, the validity flags, the load time.

    Derived columns are computed again after the joins, which costs less than shuffling them.
    `write_by` names columns that the rows are rebalanced by for a partitioned write: before the
    joins, while rows are narrow, if these shuffle nothing.
    """
    lookup = one_per_station(active_station_lookup(stations))
    budget = budget.measured(lookup)
    before = bool(write_by) and budget.admits(lookup)
    if before:
        trips = rebalanced(trips, *write_by)
    joined = with_derived(join_stations(trips.drop(*DERIVED), lookup, budget, visits))
    facts = (
        flag_validity(joined)
        .withColumn("load_dt", F.current_timestamp())
        .select(*FACT_TRIP_COLUMNS)
    )
    return rebalanced(facts, *write_by) if write_by and not before else facts


def build_fact_trip(
    raw: DataFrame, stations: DataFrame, budget: BroadcastBudget = BroadcastBudget()
) -> DataFrame:
    """The whole fact from raw trips in one batch.

    Trips are de-duplicated before they are enriched: the survivor does not depend on the station
    columns, and the rows are narrower in the one shuffle this needs.
    """
    trips = normalise_trips(raw)
    return enrich_trips(latest_trip(keyed(trips)), stations, budget, visits=trips)
