"""Nearest neighbour on the globe within a radius.

Places are put into cells of a grid of latitude and longitude that are at least as wide as the radius,
so whatever lies within it is in the same cell or in one of the eight around; only those are measured.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.operators.survivors import pick_survivor
from tripmill.sources.workdir import new_workdir

EARTH_METRES = 6_371_008.8
METRES_A_DEGREE = EARTH_METRES * math.pi / 180
# Rows of cells further from the equator than this are one cell around the globe.
POLAR = 85.0
# How much smaller a level's reach is than the next one's.
FINER = 8


def metres(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    a, b = F.radians(lat_a), F.radians(lat_b)
    half_lat = F.sin((b - a) / 2)
    half_lon = F.sin((F.radians(lon_b) - F.radians(lon_a)) / 2)
    h = half_lat * half_lat + F.cos(a) * F.cos(b) * half_lon * half_lon
    return F.lit(2 * EARTH_METRES) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _rows(radius: float) -> float:
    """Degrees of latitude of a row of cells."""
    return max(radius / METRES_A_DEGREE * 1.000001, 1e-9)


def _columns(row: Column, radius: float) -> Column:
    """How many cells a row of them has: as many of the radius's width as fit where it is narrowest."""
    outer = F.greatest(F.abs(row), F.abs(row + 1)) * F.lit(_rows(radius))
    narrow = F.cos(F.radians(F.least(outer, F.lit(POLAR))))
    fitting = F.floor(F.lit(360.0) * narrow / F.lit(_rows(radius))).cast("long")
    return F.when(outer > POLAR, F.lit(1)).otherwise(F.greatest(fitting, F.lit(1))).cast("long")


def _cell(longitude: Column, columns: Column) -> Column:
    turned = F.pmod(longitude + F.lit(180.0), F.lit(360.0))
    return F.least(F.floor(turned / F.lit(360.0) * columns).cast("long"), columns - 1)


def nearest_within(
    points: DataFrame,
    places: DataFrame,
    point_id: str,
    place_id: str,
    radius: float,
    latitude: str = "latitude",
    longitude: str = "longitude",
    levels: int = 3,
) -> DataFrame:
    """(point_id, nearest_<place_id>, metres): each point's nearest place within `radius`, if any.

    A place of the point's own id does not count. Equal distances, in whole centimetres, go to the
    smaller place id. Points and places without an id or a position take no part; a point id should
    be there once. Longitudes meet at 180 degrees, and rows of cells around the poles are one cell.

    The search goes from an eighth of an eighth of the radius up, and a level is for the points that
    found nothing below: where places are dense, points are answered in small cells, and a crowd is
    only measured from points outside it. Of places at one position the two of smallest ids stand for
    all, as one of them may be the point itself.
    """
    spots = _located(places, place_id, latitude, longitude, "b")
    order = F.row_number().over(W.partitionBy("_b_lat", "_b_lon").orderBy("_b"))
    spots = spots.distinct().withColumn("_nth", order).filter("_nth <= 2").drop("_nth")
    left = _located(points, point_id, latitude, longitude, "a")
    spark, path = points.sparkSession, new_workdir(points.sparkSession, "nearest")
    for level in reversed(range(levels)):
        reach = radius / FINER**level
        best = _nearest_in_cells(left, spots, reach)
        if level:
            # What lies beyond the reach may round to the same centimetre, but to no smaller one.
            best = best.filter(F.col("_cents") < F.lit(math.floor(reach * 100)))
        best.write.parquet(f"{path}/level={level}")
        found = spark.read.schema(best.schema).parquet(f"{path}/level={level}")
        left = left.join(found.select(F.col("_a").alias("_done")), F.col("_a") == F.col("_done"), "left_anti")
    every = spark.read.schema(best.schema).parquet(path)
    return every.select(
        F.col("_a").alias(point_id), F.col("_b").alias(f"nearest_{place_id}"), "metres"
    )


def _located(df: DataFrame, name: str, latitude: str, longitude: str, side: str) -> DataFrame:
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    rows = df.select(
        F.col(name).alias(f"_{side}"), lat.alias(f"_{side}_lat"), lon.alias(f"_{side}_lon")
    )
    known = F.col(f"_{side}").isNotNull() & (F.abs(f"_{side}_lat") <= 90)
    return rows.filter(known & (F.abs(f"_{side}_lon") <= 360))


def _nearest_in_cells(points: DataFrame, places: DataFrame, radius: float) -> DataFrame:
    """(_a, _b, metres, _cents): the nearest place within the radius of each point that has one."""

    def row_of(latitude: str) -> Column:
        return F.floor(F.col(latitude) / F.lit(_rows(radius))).cast("long")

    indexed = places.withColumn("_row", row_of("_b_lat"))
    indexed = indexed.withColumn("_cell", _cell(F.col("_b_lon"), _columns(F.col("_row"), radius)))
    rows = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: row_of("_a_lat") + d)
    looking = points.withColumn("_row", F.explode(rows))
    columns = _columns(F.col("_row"), radius)
    own = _cell(F.col("_a_lon"), columns)
    around = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(own + d, columns))
    looking = looking.withColumn("_cell", F.explode(F.array_distinct(around)))
    distance = metres(*[F.col(f"_{side}_{axis}") for side in "ab" for axis in ("lat", "lon")])
    met = looking.join(indexed, ["_row", "_cell"]).filter(F.col("_a") != F.col("_b"))
    met = met.withColumn("metres", distance).filter(F.col("metres") <= radius)
    met = met.withColumn("_cents", F.rint(F.col("metres") * 100).cast("long"))
    best = pick_survivor(met, ["_a"], [F.col("_cents").asc(), F.col("_b").asc()])
    return best.select("_a", "_b", "metres", "_cents")
