"""Running values over range partitions, against plain windows; one key holds most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.operators.sequence import PART, in_parts, latest_value, previous_row, running_total

ORDER = ["key", "at", "row"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    made = [
        (i, draw.choice(["hot"] * 8 + ["a", "b", None]), draw.randint(0, 400),
         draw.choice([None, None, None, draw.randint(-9, 9)]))
        for i in range(2000)
    ]
    made += [(2000 + i, "late", i, None) for i in range(50)]
    return spark.createDataFrame(made, "row long, key string, at long, value long").repartition(5)


@pytest.fixture(scope="module")
def parted(rows):
    return in_parts(rows, ORDER, "test-sequence", 7).cache()


def same(got, expected):
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        map(tuple, expected.collect()), key=key
    )


def test_parts_follow_each_other_and_split_the_hot_key(parted):
    sizes = [r["count"] for r in parted.groupBy(PART).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 0.3 * sum(sizes)
    spans = parted.groupBy(PART).agg(
        F.min(F.struct("key", "at", "row")).alias("first"),
        F.max(F.struct("key", "at", "row")).alias("last"),
    )
    found = [r for r in spans.orderBy(PART).collect()]
    null_first = lambda s: tuple((x is not None, x) for x in s)
    for one, following in zip(found, found[1:]):
        assert null_first(one["last"]) < null_first(following["first"])


def test_running_total(parted, rows):
    value = F.coalesce("value", F.lit(1))
    keyed = W.partitionBy("key").orderBy("at", "row")
    got = running_total(parted, ["key"], ORDER, value, "total").drop(PART)
    same(got, rows.withColumn("total", F.sum(value).over(keyed)))
    alone = W.partitionBy().orderBy(*ORDER)
    got = running_total(parted, [], ORDER, F.lit(1).cast("long"), "place").drop(PART)
    same(got, rows.withColumn("place", F.row_number().over(alone).cast("long")))


def test_previous_row(parted, rows):
    keyed = W.partitionBy("key").orderBy("at", "row")
    left = F.struct("row", "value")
    got = previous_row(parted, ["key"], ORDER, left, "before").drop(PART)
    same(got, rows.withColumn("before", F.lag(left).over(keyed)))


def test_latest_value(parted, rows):
    keyed = W.partitionBy("key").orderBy("at", "row")
    got = latest_value(parted, ["key"], ORDER, F.col("value"), "known").drop(PART)
    same(got, rows.withColumn("known", F.last("value", ignorenulls=True).over(keyed)))


def test_only_summaries_meet_in_a_window_of_the_key(parted):
    """A window of the key alone has an aggregate below it; the rows' own windows have the part."""
    total = running_total(parted, ["key"], ORDER, F.lit(1).cast("long"), "n")
    for df in (total, previous_row(parted, ["key"], ORDER, F.struct("row"), "b")):
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        windows = [i for i, line in enumerate(lines) if "Window [" in line]
        alone = [i for i in windows if f"{PART}#" not in lines[i].split("], [")[1]]
        assert len(alone) == 1
        assert any("Aggregate [" in line for line in lines[alone[0] + 1 : alone[0] + 3])


def test_empty(spark):
    none = spark.createDataFrame([], "row long, key string, at long, value long")
    parted = in_parts(none, ORDER, "test-empty")
    assert running_total(parted, ["key"], ORDER, F.col("value"), "n").count() == 0
    assert previous_row(parted, [], ORDER, F.struct("row"), "b").count() == 0
