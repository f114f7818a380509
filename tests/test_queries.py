"""Queries over tables of a few rows made here."""

from __future__ import annotations

import datetime as dt

import pytest

from tripmill import fixtures
from tripmill import queries as library
from tripmill.plans import marts
from tripmill.plans.refresh import partitioned_marts
from tripmill.streaming.sink import fact_table


def event(number: int) -> tuple:
    """Eight trips a day from the first to the 25th of the month, some in the late evening."""
    ts = dt.datetime(2024, 1, 1 + number // 8, 2 + 3 * (number % 8), 7, 5)
    return (number, ts, number % 9, "purchase" if number % 3 else "view", 12.5, f'{{"k": {number % 6}}}')


ROWS = {
    "region": [(0, "R")],
    "nation": [(0, "N", 0)],
    "supplier": [(number, f"S{number}", 0, 5000.0) for number in range(8)],
    "events": [event(number) for number in range(200)],
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, fixtures.TABLES[name]).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_the_last_refreshes_by_tag_are_of_all_marts(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(library, "new_workdir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    refreshed = []

    def refresh(*args, **options):
        refreshed.append(len(refresh_dates(*args, **options)))

    refresh_dates = library.refresh_touched_dates
    monkeypatch.setattr(library, "refresh_touched_dates", refresh)
    library.QUERIES["mart_refresh_by_tag"](spark, tables)
    # All dates at the second load, as two of the marts have seen none; then only those of its replay.
    assert refreshed == [20, 25, 15]
    root = f"{tmp_path}/mart_refresh_by_tag"
    facts = fact_table(f"{root}/fact_trip").read(spark)
    for mart in marts.MARTS.values():
        stored, built = partitioned_marts(f"{root}/gold")(mart).read(spark), mart.build(facts)
        columns = [c for c in built.columns if c != "mart_load_dt"]
        found, expected = (sorted(map(str, df.select(columns).collect())) for df in (stored, built))
        assert found == expected and found
