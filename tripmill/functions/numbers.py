"""Exact half-up rounding of means and ratios.

`round(avg(double), 2)` depends on the order in which doubles were added, so two runs over the
same rows can round a tie differently. Durations have two decimals, so their sum is an exact
integer number of hundredths; dividing integers gives the same answer under any partitioning,
and long sums stay in the hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer dividend / positive integer divisor, rounded to nearest, ties away from zero."""
    double = divisor * 2
    magnitude = F.call_function("div", F.abs(dividend) * 2 + divisor, F.nullif(double, F.lit(0)))
    return F.when(dividend < 0, -magnitude).otherwise(magnitude)


def hundredths(value: Column) -> Column:
    """A two-decimal value as a whole number. `rint` is a machine instruction, `round` is not."""
    return F.rint(value * 100).cast("long")


def mean_2dp(total_hundredths: Column, count: Column) -> Column:
    return half_up_quotient(total_hundredths, count) / F.lit(100.0)


def exact_mean(value: Column) -> Column:
    """Aggregate: mean of a two-decimal column, rounded half-up to two decimals."""
    return mean_2dp(F.sum(hundredths(value)), F.count(value))


def ratio_4dp(part: Column, whole: Column) -> Column:
    return half_up_quotient(part * 10000, whole) / F.lit(10000.0)
