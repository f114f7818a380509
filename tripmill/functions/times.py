"""Instants and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(name: str) -> Column:
    """ISO text to a timestamp; text that is no timestamp becomes null instead of an error."""
    return F.try_to_timestamp(F.col(name)).alias(name)


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two instants, two decimals.

    Each instant loses its fraction before the subtraction, so the result counts the second
    marks passed, not the elapsed time. A second is 5/3 hundredths of a minute, so no whole number
    of seconds lies half-way between two hundredths and every way of rounding agrees.
    """
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    return F.rint(seconds * 100 / F.lit(60)) / F.lit(100)
