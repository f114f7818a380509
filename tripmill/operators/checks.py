"""Data-quality checks: guards that raise, audits that report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_rows(count: int, what: str) -> int:
    """Guard against an empty input or output."""
    if count == 0:
        raise ValueError(f"{what} has no rows")
    return count


def non_null_audit(df: DataFrame, check: str, columns: Sequence[str]) -> DataFrame:
    """One row per checked column with its number of nulls; the check passes when all are 0."""
    nulls = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    lines = [_line(check, name, F.col(name)) for name in columns]
    return nulls.select(F.inline(F.array(*lines)))


def unique_audit(df: DataFrame, check: str, key: Sequence[str]) -> DataFrame:
    """One row with the number of keys that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return repeated.agg(F.count("*").alias("n")).select(
        F.inline(F.array(_line(check, ",".join(key), F.col("n"))))
    )


def audit_history(lines: DataFrame) -> DataFrame:
    """Each check over all stored runs: how many there were, how many failed, and what the last said.

    `lines` are stored audit lines with their `run_dt`; lines of one run and check count once, with
    the most violations that they tell.
    """
    runs = lines.groupBy("check_name", "column_name", "run_dt").agg(
        F.max("violations").alias("violations")
    )
    failed = F.col("violations") > 0
    return runs.groupBy("check_name", "column_name").agg(
        F.count("*").alias("runs"),
        F.count_if(failed).alias("failed_runs"),
        F.max_by("violations", "run_dt").alias("last_violations"),
        F.min("run_dt").alias("first_run_dt"),
        F.max("run_dt").alias("last_run_dt"),
        F.max(F.when(failed, F.col("run_dt"))).alias("last_failed_dt"),
    )


def _line(check, column, violations):
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        violations.cast("long").alias("violations"),
    )
