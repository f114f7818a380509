from __future__ import annotations

import hashlib

import pytest

from tests.helpers import STATION_HEADER, stations
from tripmill.plans.dim_station import build_dim_station, load_dim_station, station_rejects
from tripmill.schemas import DIM_STATION_COLUMNS, STATION_CSV
from tripmill.sources.files import read_station_csv
from tripmill.sources.tables import ConnectorTable, SnapshotTable


def write_csv(tmp_path, *lines, header=STATION_HEADER):
    path = tmp_path / "stations.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


GOOD = "st1, Alpha ,49.1,-123.1,20, North ,True,2020-05-01"


def test_normalised_keyed_and_rejected(spark):
    raw = stations(
        spark, (" st1 ", " Alpha ", " North ", True), ("   ", "x", "y", True),
        (None, "x", "y", True),
    )
    (row,) = build_dim_station(raw).collect()
    assert (row.station_id, row.station_name, row.neighbourhood) == ("ST1", "Alpha", "North")
    assert row.station_key == hashlib.sha256(b"ST1").hexdigest()
    assert row.load_dt is not None
    assert build_dim_station(raw).columns == DIM_STATION_COLUMNS
    rejects = {r.reason: r.station_rows for r in station_rejects(raw).collect()}
    assert rejects == {"station_id_null": 1, "station_id_blank": 1}


def test_latest_launch_survives_whatever_the_order(spark):
    rows = [
        ("s", "old", 1.0, 1.0, 5, "n", True, None),
        (" S", "new", 1.0, 1.0, 5, "n", True, "2021-01-01"),
        ("s ", "mid", 1.0, 1.0, 5, "n", True, "2020-01-01"),
    ]
    for ordering in (rows, rows[::-1]):
        text = spark.createDataFrame(ordering, STATION_CSV.replace("DATE", "STRING"))
        raw = text.withColumn("launch_date", text.launch_date.cast("date")).repartition(3)
        assert [r.station_name for r in build_dim_station(raw).collect()] == ["new"]


def test_csv_load_publishes_and_counts(spark, tmp_path):
    path = write_csv(tmp_path, GOOD, GOOD, " ,Blank,1,1,1,x,False,2020-05-01")
    target = SnapshotTable(str(tmp_path / "dim"))
    load = load_dim_station(spark, path, target, preview_rows=5)
    assert (load.raw_rows, load.stations) == (3, 1)
    (row,) = target.read(spark).collect()
    assert row.file_name.endswith("stations.csv") and row.is_active is True
    assert str(row.launch_date) == "2020-05-01"


@pytest.mark.parametrize("lines", [(), (" ,Blank,1,1,1,x,True,2020-05-01",)])
def test_empty_input_or_output_publishes_nothing(spark, tmp_path, lines):
    target = SnapshotTable(str(tmp_path / "dim"))
    with pytest.raises(ValueError, match="no rows"):
        load_dim_station(spark, write_csv(tmp_path, *lines), target)
    assert target.current(spark) is None


def test_failed_refresh_keeps_the_published_version(spark, tmp_path):
    target = SnapshotTable(str(tmp_path / "dim"))
    load_dim_station(spark, write_csv(tmp_path, GOOD), target)
    before = target.read(spark)
    with pytest.raises(ValueError):
        load_dim_station(spark, write_csv(tmp_path), target)
    load_dim_station(spark, write_csv(tmp_path, GOOD.replace("Alpha", "Omega")), target)
    assert before.first().station_name == "Alpha"
    assert target.read(spark).first().station_name == "Omega"


@pytest.mark.parametrize(
    "bad", ["st1,Alpha,49.1,-123.1,many,North,True,2020-05-01", "st1,Alpha,49.1"]
)
def test_bad_rows_raise_on_full_read(spark, tmp_path, bad):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_station_csv(spark, write_csv(tmp_path, GOOD, bad)).collect()


def test_swapped_header_raises(spark, tmp_path):
    swapped = STATION_HEADER.replace("station_id,station_name", "station_name,station_id")
    with pytest.raises(Exception, match="(?i)header"):
        read_station_csv(spark, write_csv(tmp_path, GOOD, header=swapped)).collect()


def test_catalog_and_format_targets(spark, tmp_path):
    path = write_csv(tmp_path, GOOD)
    as_files = ConnectorTable(format="orc", options={"path": str(tmp_path / "orc")})
    assert load_dim_station(spark, path, as_files).stations == 1
    assert as_files.read(spark).first().station_id == "ST1"
    with pytest.raises(ValueError):
        load_dim_station(spark, write_csv(tmp_path), as_files)
    assert as_files.read(spark).count() == 1
    catalog = ConnectorTable(name="dim_station_test")
    spark.sql(
        f"CREATE TABLE dim_station_test (x INT) USING parquet LOCATION '{tmp_path / 'cat'}'"
    )
    try:
        catalog.replace(build_dim_station(stations(spark, ("z", "Zed", "n", True))))
        assert catalog.read(spark).first().station_id == "Z"
    finally:
        spark.sql("DROP TABLE dim_station_test")
