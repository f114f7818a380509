"""Sketches and cubes over the trips, and the reconciliation of what is stored."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import trip, trips, two_stations
from tripmill.operators.cleaning import normalise_trips
from tripmill.plans import cubes, sketches
from tripmill.plans.dim_station import build_dim_station
from tripmill.plans.fact_trip import build_fact_trip
from tripmill.plans.reconciliation import reconciliation


def facts_of(spark, *events):
    return build_fact_trip(trips(spark, *events), build_dim_station(two_stations(spark)))


def many(spark, count):
    """Valid facts in the columns that sketches read."""
    return spark.range(count).select(
        F.date_add(F.lit("2024-05-01").cast("date"), (F.col("id") % 5).cast("int")).alias("trip_date"),
        (F.col("id") % 24).cast("int").alias("trip_hour"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("start_neighbourhood"),
        F.lit("classic").alias("bike_type"),
        F.lit(None).cast("string").alias("user_type"),
        F.concat(F.lit("bike"), F.col("id") % 40_000).alias("bike_id"),
        F.concat(F.lit("user"), F.col("id") % 90_001).alias("user_id"),
        (F.pmod(F.xxhash64("id"), F.lit(20_000)) / 100).alias("trip_duration_minutes"),
        F.lit(True).alias("is_valid_trip"),
    )


def test_sketches_merge_within_their_error(spark, tmp_path):
    facts, table = many(spark, 400_000), sketches.sketch_table(f"{tmp_path}/sketches")
    early = F.col("trip_date") < F.lit("2024-05-03").cast("date")
    for load, part in (("1", facts.filter(early)), ("2", facts.filter(~early)), ("2", facts.filter(~early))):
        sketches.add_load(table, part, load)
    ranks = (0.0, 0.1, 0.5, 0.99, 1.0)
    (row,) = sketches.estimated(sketches.merged(table.read(spark), []), ranks).collect()
    assert row["trip_count"] == 400_000
    assert row["active_bikes"] == pytest.approx(40_000, rel=0.05)
    assert row["active_users"] == pytest.approx(90_001, rel=0.05)
    exact = facts.agg(F.min("trip_duration_minutes"), F.max("trip_duration_minutes")).first()
    assert (row["duration_quantiles"][0], row["duration_quantiles"][-1]) == tuple(exact)
    for rank, value in zip(ranks[1:-1], row["duration_quantiles"][1:-1]):
        assert facts.filter(F.col("trip_duration_minutes") <= value).count() == pytest.approx(
            rank * 400_000, abs=0.03 * 400_000
        )
    days = sketches.estimated(sketches.merged(table.read(spark), ["trip_date", "start_neighbourhood"]))
    assert days.count() == 15


def test_sketches_of_few_are_exact(spark):
    events = [trip(f"t{i}", bike_id=f"b{i % 7}", user_id=None if i % 2 else f"u{i}") for i in range(20)]
    facts = facts_of(spark, *events, trip("bad", bike_id="other", start_station_id="nowhere"))
    (row,) = sketches.estimated(sketches.merged(sketches.trip_sketches(facts), [])).collect()
    assert (row["trip_count"], row["active_bikes"], row["active_users"]) == (20, 7, 10)


def test_merging_reads_no_fact(spark, tmp_path):
    table = sketches.sketch_table(f"{tmp_path}/sketches")
    sketches.add_load(table, many(spark, 100), "1")
    plan = sketches.merged(table.read(spark), ["bike_type"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_theta_union_agg" in plan
    read = plan.split("FileScan parquet [")[1].split("]")[0]
    assert "trip_date" not in read and "trip_hour" not in read


def test_returning(spark):
    def on(day, user, i):
        when = f"2024-05-{day:02}T10:00:00+00:00"
        return trip(f"t{i}", user_id=user, start_time=when, end_time=when.replace("T10", "T11"))

    seen = [(1, "a"), (1, "b"), (2, "c"), (9, "a"), (9, "d"), (5, "b")]
    facts = facts_of(spark, *[on(day, user, i) for i, (day, user) in enumerate(seen)])
    found = sketches.returning(sketches.trip_sketches(facts), "users", "2024-05-03", "2024-05-08")
    assert tuple(found.first()) == (1, 2)


@pytest.fixture(scope="module")
def few(spark):
    events = [
        trip("t1", user_type=None, bike_id="x", user_id="u"),
        trip("t2", user_type=None, bike_id="x", user_id="v"),
        trip("t3", user_type="member", bike_id="x", user_id="u", start_station_id="b"),
        trip("t4", user_type="casual", bike_type="e-bike", bike_id="y", user_id="u"),
        trip("t5", user_type="casual", end_time=None),
    ]
    return facts_of(spark, *events)


def test_null_groups_are_not_all(few):
    rows = cubes.demand_cube(few, ("user_type", "bike_type")).collect()
    at = {(r["user_type"], r["user_type_is_all"], r["bike_type"], r["bike_type_is_all"]): r for r in rows}
    assert len(at) == len(rows) == 3 + 3 + 2 + 1
    unknown, everyone = at[None, False, None, True], at[None, True, None, True]
    assert (unknown["trip_count"], unknown["active_users"], unknown["grouping_level"]) == (2, 2, 1)
    assert (everyone["trip_count"], everyone["active_bikes"], everyone["active_users"]) == (4, 2, 2)
    assert everyone["grouping_level"] == 3


def test_rollup_and_grouping_sets(few):
    levels = [r["grouping_level"] for r in cubes.demand_rollup(few).collect()]
    assert sorted(levels) == [0, 1, 3]
    sets = [["bike_type"], ["user_type", "bike_type"]]
    found = cubes.demand_grouping_sets(few, sets, ["user_type", "bike_type"]).collect()
    assert sorted(r["grouping_level"] for r in found) == [0, 0, 0, 2, 2]


def test_a_cube_reads_the_trips_once_and_combines_before_exchanges(few):
    plan = cubes.demand_cube(few)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "bike_id" in lines[-1] or any("bike_id" in line for line in lines)
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") <= 3


def parts(found):
    return {r["part"]: r["trip_rows"] for r in found.collect() if r["trip_rows"]}


def test_reconciliation(spark):
    old, new = trip("t1"), trip("t1", user_type="casual", event_created_at="2024-05-02T00:00:00+00:00")
    alone, lost = trip("t2"), trip("t3")
    landed = normalise_trips(trips(spark, old, new, new, alone, lost, trip(None), trip(None)))
    fact = normalise_trips(trips(spark, new, alone))
    nulls = normalise_trips(trips(spark, trip(None)))
    assert parts(reconciliation(landed, fact, nulls)) == {
        "landed": 7, "stored": 2, "beaten": 2, "missing": 1, "quarantined": 1, "not_quarantined": 1
    }
    stale = normalise_trips(trips(spark, old, old, trip("t9")))
    assert parts(reconciliation(landed, stale, landed.limit(0))) == {
        "landed": 7, "stored": 1, "superseded_only": 2, "missing": 2, "not_quarantined": 2, "invented": 2
    }
