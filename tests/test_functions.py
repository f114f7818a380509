"""Rounding against independent arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from tripmill.functions.numbers import exact_mean, ratio_4dp
from tripmill.functions.times import duration_minutes


def half_up(value: Fraction, digits: int) -> float:
    scaled = value * 10**digits
    return math.floor(scaled + Fraction(1, 2)) / 10**digits


def test_durations_equal_decimal_rounding_of_the_quotient(spark):
    """Every length up to 5,000 minutes in both directions, and some of several years."""
    seconds = F.col("id")
    spans = spark.range(-300_000, 300_001).unionByName(
        spark.range(90_000_000, 90_100_000)
    )
    zero = F.timestamp_seconds(F.lit(0))
    ours = duration_minutes(zero, F.timestamp_seconds(seconds))
    rounded = F.round(seconds / F.lit(60), 2)
    assert spans.filter(ours != rounded).isEmpty()


def test_means_are_exact_whatever_the_grouping(spark):
    rng = random.Random(7)
    rows = [
        (group, rng.randint(1, 60_000) / 100)
        for group in range(300)
        for _ in range(rng.randint(1, 9))
    ]
    expected = {}
    for group in range(300):
        cents = [round(value * 100) for key, value in rows if key == group]
        expected[group] = half_up(Fraction(sum(cents), len(cents) * 100), 2)
    df = spark.createDataFrame(rows, "g int, d double")
    for parts in (1, 7):
        means = df.repartition(parts).groupBy("g").agg(exact_mean(F.col("d")).alias("m"))
        assert {row.g: row.m for row in means.collect()} == expected


def test_ratios(spark):
    rng = random.Random(11)
    pairs = [(rng.randint(0, 500), rng.randint(1, 500)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "part long, whole long")
    found = df.select("part", "whole", ratio_4dp(F.col("part"), F.col("whole"))).collect()
    assert all(value == half_up(Fraction(part, whole), 4) for part, whole, value in found)
