"""Station CSV and trip JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schemas import STATION_COLUMNS, STATION_CSV, TRIP_COLUMNS, TRIP_JSON
from tripmill.sources.tables import rebalanced

CORRUPT = "_corrupt_record"


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station rows with their source file. Bad rows and a header in another order raise.

    The header is compared with the schema because columns bind by position. Bad rows raise only
    when their columns are read, so a bare `count()` is no validation.
    """
    return (
        spark.read.schema(STATION_CSV)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
        .select(*STATION_COLUMNS, F.col("_metadata.file_path").alias("file_name"))
    )


def read_trip_json(
    spark: SparkSession,
    path: str,
    ingest_from: str | None = None,
    ingest_to: str | None = None,
) -> DataFrame:
    """Landed trip events; the optional bounds (inclusive dates) prune landing directories.

    With bounds, `path` must be the root of the landing, which holds the date directories. Files of
    every name are read, except those Spark takes for hidden.
    """
    landed = (
        spark.read.schema(f"{TRIP_JSON}, {CORRUPT} STRING, ingest_date DATE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    if ingest_from is not None:
        landed = landed.filter(F.col("ingest_date") >= F.lit(ingest_from).cast("date"))
    if ingest_to is not None:
        landed = landed.filter(F.col("ingest_date") <= F.lit(ingest_to).cast("date"))
    return _trip_rows(landed)


def stream_trip_json(
    spark: SparkSession,
    path: str,
    max_files: int = 1000,
    max_bytes: int | None = None,
    **options: str,
) -> DataFrame:
    """The landing directory as a stream.

    `max_files` or `max_bytes` (not both) bounds one micro-batch. Files of every name are read;
    further file source options, such as `pathGlobFilter`, `maxFileAge` or `cleanSource`, pass
    through.
    """
    reader = (
        spark.readStream.schema(f"{TRIP_JSON}, {CORRUPT} STRING")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**options)
    )
    if max_bytes is None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _trip_rows(reader.json(path))


def _trip_rows(landed: DataFrame) -> DataFrame:
    """The declared columns only, whether or not the landing has date directories yet."""
    return landed.select(*TRIP_COLUMNS, CORRUPT, F.col("_metadata.file_path").alias("file_name"))


def land_trips(trips: DataFrame, path: str) -> None:
    """Append raw trips to a landing: JSON lines under `ingest_date=YYYY-MM-DD` directories.

    The ingest date is the date on which the event was created, as in its text; events whose text
    has no date land under the null date.
    """
    created = F.to_date(F.try_to_timestamp(F.substring("event_created_at", 1, 10)))
    dated = trips.select(*TRIP_COLUMNS, created.alias("ingest_date"))
    rebalanced(dated, "ingest_date").write.mode("append").partitionBy("ingest_date").json(path)
