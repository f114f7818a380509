"""The station dimension: one row per normalised station id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.text import surrogate_key
from tripmill.operators.checks import require_rows
from tripmill.operators.cleaning import (
    has_station_id,
    normalise_stations,
    station_reject_reason,
)
from tripmill.operators.survivors import surviving_station
from tripmill.schemas import DIM_STATION_COLUMNS
from tripmill.sources.files import read_station_csv
from tripmill.sources.tables import ConnectorTable, SnapshotTable


def build_dim_station(raw: DataFrame) -> DataFrame:
    kept = normalise_stations(raw).filter(has_station_id())
    return (
        surviving_station(kept)
        .withColumns(
            {
                "station_key": surrogate_key(F.col("station_id")),
                "load_dt": F.current_timestamp(),
            }
        )
        .select(*DIM_STATION_COLUMNS)
    )


def station_rejects(raw: DataFrame) -> DataFrame:
    """Rows kept out of the dimension for lack of an id, counted by reason."""
    return (
        normalise_stations(raw)
        .select(station_reject_reason().alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("station_rows"))
    )


def preview(dim: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by station id."""
    return dim.orderBy("station_id").limit(rows)


@dataclass(frozen=True)
class DimensionLoad:
    """Row counts of one dimension refresh."""

    raw_rows: int
    stations: int


def load_dim_station(
    spark: SparkSession,
    station_path: str,
    target: SnapshotTable | ConnectorTable,
    preview_rows: int = 0,
    keep: int = 3,
) -> DimensionLoad:
    """Station CSV to the dimension table, replaced as a whole.

    Both counts are observed while the rows are written; an empty input or output raises before
    the new rows become visible. The preview reads the written table, not the plan again. Of a
    snapshot table the newest `keep` versions stay; running readers may hold an older one.
    """
    raw_seen, kept_seen = Observation(), Observation()
    raw = read_station_csv(spark, station_path).observe(raw_seen, F.count("*").alias("n"))
    dim = build_dim_station(raw).observe(kept_seen, F.count("*").alias("n"))

    def both_have_rows() -> None:
        require_rows(observed(raw_seen), "station file")
        require_rows(observed(kept_seen), "station dimension after cleaning")

    target.replace(dim, check=both_have_rows)
    if isinstance(target, SnapshotTable):
        target.keep_newest(spark, keep)
    if preview_rows:
        preview(target.read(spark), preview_rows).show(preview_rows, truncate=False)
    return DimensionLoad(observed(raw_seen), observed(kept_seen))


def observed(observation: Observation) -> int:
    """An observed row count; an empty branch that was optimised away reports nothing, so 0."""
    return observation.get.get("n") or 0
