from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import trip, trips
from tripmill.operators.asof import as_of
from tripmill.operators.cleaning import normalise_trips
from tripmill.operators.lookup import BroadcastBudget
from tripmill.plans import movements
from tripmill.schemas import STATION_CSV

FORMS = {"broadcast": BroadcastBudget(), "merged": BroadcastBudget(limit_bytes=0, known_bytes=1)}
START = datetime(2024, 1, 1)


def moment(hours):
    return None if hours is None else START + timedelta(hours=hours)


@pytest.fixture(params=sorted(FORMS))
def budget(request):
    return FORMS[request.param]


def test_against_the_plain_form(spark, budget):
    draw = random.Random(1)
    keys = ["hot"] * 10 + ["a", "b", "never", None]
    left = [(i, draw.choice(keys), draw.choice([None, *range(60)])) for i in range(800)]
    left += left[:20]
    right = [(draw.choice(["hot", "a", "b", None]), draw.choice([None, *range(5, 60, 3)]),
              draw.choice("xyz"), draw.choice([None, 1, 2])) for _ in range(80)]
    rows = spark.createDataFrame([(i, k, moment(h)) for i, k, h in left], "id long, k string, t timestamp")
    versions = spark.createDataFrame(
        [(k, moment(h), n, c) for k, h, n, c in right], "k string, since timestamp, name string, cap int"
    )
    found = as_of(rows.repartition(4), versions, "k", "t", "since", "v", budget)
    assert found.columns == ["id", "k", "t", "v"]
    got = sorted(
        ((r["id"], r["v"] and (r["v"]["since"], r["v"]["name"], r["v"]["cap"])) for r in found.collect()),
        key=repr,
    )

    def holds(k, h):
        able = [v for v in right if None not in (k, h, v[1]) and v[0] == k and v[1] <= h]
        if not able:
            return None
        best = max(able, key=lambda v: (v[1], v[2], v[3] is not None, v[3] or 0))
        return moment(best[1]), best[2], best[3]

    assert got == sorted(((i, holds(k, h)) for i, k, h in left), key=repr)


def test_names_that_both_sides_use(spark, budget):
    rows = spark.createDataFrame([("a", moment(5), 1)], "k string, t timestamp, size int")
    versions = spark.createDataFrame([("a", moment(1), 9)], "k string, since timestamp, size int")
    row = as_of(rows, versions, "k", "t", "since", "v", budget).first()
    assert (row["size"], row["v"]["size"]) == (1, 9)


def test_stations_of_a_trip(spark, budget):
    def version(name, active, launch):
        return (" a ", name, 49.0, -123.0, 5, "N", active, launch)

    raw = spark.createDataFrame(
        [version("old", True, None), version("mid", False, datetime(2024, 5, 1).date()),
         version("new", True, datetime(2024, 5, 2).date()),
         (None, "x", 0.0, 0.0, 1, "N", True, None)], STATION_CSV
    )
    times = {"t0": "2024-04-30T23:59:59+00:00", "t1": "2024-05-01T00:00:00+00:00",
             "t2": "2024-05-03T00:00:00+00:00"}
    made = [trip(i, start_station_id="a", end_station_id="q", start_time=t, end_time=None)
            for i, t in times.items()]
    versions = movements.station_versions(raw)
    found = movements.trips_as_of(normalise_trips(trips(spark, *made)), versions, budget)
    got = {r["trip_id"]: r for r in found.collect()}
    names = [got[i]["start_station_name"] for i in ("T0", "T1", "T2")]
    assert names == ["old", "mid", "new"]
    assert got["T0"]["start_launch_date"] is None
    assert [got[i]["start_is_open"] for i in ("T0", "T1", "T2")] == [True, False, True]
    assert not any(r["end_is_open"] or r["end_station_name"] for r in got.values())


def test_broadcast_form_moves_no_trips(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("k"), F.current_timestamp().alias("t"))
    versions = rows.select("k", F.col("t").alias("since"), F.lit(1).alias("n"))
    plan = as_of(rows, versions, "k", "t", "since", "v")._jdf.queryExecution().executedPlan().toString()
    left = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in left and "Exchange hashpartitioning" not in left
