"""Session settings the library depends on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Trip dates and hours are UTC calendar values, whatever zone the cluster runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Raises where instants would be read as another zone's calendar values."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"the session's time zone is {zone}; trip dates and hours need UTC")


def job_session(app_name: str) -> SparkSession:
    """Session of a submitted job; master, memory and catalogs come from spark-submit."""
    return pin_utc(SparkSession.builder.appName(app_name).getOrCreate())
