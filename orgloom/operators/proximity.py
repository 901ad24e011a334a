"""Points near other points, and points in regions, by grid cells.

Points are hashed to cells whose side is the radius. Rows of cells are bands of
latitude; each band has its own number of columns, so that a cell is at least a
radius wide anywhere in the bands beside it. A point meets another only if that
one's cell is the same or a neighbour, which makes the join an equality join;
the exact great-circle distance decides afterwards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.operators.skew import salted_join
from orgloom.session import cut

EARTH_RADIUS_M = 6_371_008.8
#: A cell with more points than this is split into salted parts.
HOT_CELL = 20_000


def great_circle_m(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Metres between two points on the sphere (haversine)."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat_a, lat_b) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half(lng_a, lng_b)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def is_coordinate(lat: Column, lng: Column) -> Column:
    """True only for finite latitudes and longitudes on the globe."""
    return F.coalesce(lat.between(-90, 90) & lng.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lng), F.lit(False))


def _band(lat: Column, radius_m: float) -> Column:
    step = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)
    return F.floor((lat + 90) / step).cast("long")


def _columns(band: Column, radius_m: float) -> Column:
    """How many cells a band is divided into: none is narrower than the radius, seen from this band or one beside it."""
    step = math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)
    edge = F.greatest(F.abs((band - 1) * step - 90), F.abs((band + 2) * step - 90))
    ratio = F.lit(math.sin(min(radius_m / EARTH_RADIUS_M, math.pi) / 2)) / F.cos(F.radians(edge))
    width = 2 * F.degrees(F.asin(ratio)) * (1 + 1e-9)
    return F.when((edge < 89.9) & (ratio < 0.5), F.floor(360 / width)).otherwise(1).cast("long")


def _cell(band: Column, lng: Column, shift: int, radius_m: float) -> Column:
    n = _columns(band, radius_m)
    n = F.when(n < 4, F.lit(1)).otherwise(n)
    column = F.pmod(F.floor((lng + 180) / 360 * n).cast("long") + shift, n)
    return F.shiftleft(band, 34) + column


def pairs_within(points: DataFrame, id_col: str, lat_col: str, lng_col: str, radius_m: float, hot_cell: int = HOT_CELL) -> DataFrame:
    """All pairs of rows at most ``radius_m`` apart: ``id_a``, ``id_b`` (``id_a < id_b``) and ``distance_m``.

    Rows with a null id or without a coordinate on the globe (null, NaN, out of
    range) pair with nothing; rows with equal ids don't pair with one another,
    and repeated rows give their pairs once. Rows at the same place pair at
    distance 0. An empty table gives an empty result. Other columns are
    ignored, whatever their names. The radius must be positive and finite.

    Every point looks into its own cell and into four of the eight around it,
    which meets each pair of cells once. Cells that hold more than ``hot_cell``
    points are split by a salt of the one side and copied on the other, so no
    task has to join a hot cell alone.
    """
    if not 0 < radius_m < math.inf:
        raise ValueError("the radius must be positive and finite")
    at = points.select(F.col(id_col).alias("id"), F.col(lat_col).cast("double").alias("lat"), F.col(lng_col).cast("double").alias("lng"))
    at = at.filter(F.col("id").isNotNull() & is_coordinate(F.col("lat"), F.col("lng"))).withColumn("band", _band(F.col("lat"), radius_m))
    lng, band = F.col("lng"), F.col("band")
    home = at.withColumn("cell", _cell(band, lng, 0, radius_m))
    reach = F.array_distinct(
        F.array(
            F.col("cell"), _cell(band, lng, 1, radius_m), _cell(band + 1, lng, -1, radius_m), _cell(band + 1, lng, 0, radius_m), _cell(band + 1, lng, 1, radius_m)
        )
    )
    hot = home.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_cell)
    hot = hot.select("cell", F.ceil(F.col("n") / hot_cell).cast("int").alias("parts"))
    build = home.select("cell", F.col("id").alias("id_b"), F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"))
    build = build.join(hot, "cell", "left").withColumn("salt", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("id_b"), F.col("parts"))).otherwise(0).cast("int"))
    probe = home.select(F.col("id").alias("id_a"), F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"), F.col("cell").alias("own"), F.explode(reach).alias("cell"))
    probe = probe.join(hot, "cell", "left").withColumn("salt", F.explode(F.when(F.col("parts").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))))
    met = probe.drop("parts").join(build.drop("parts"), ["cell", "salt"])
    met = met.filter((F.col("id_a") != F.col("id_b")) & ((F.col("own") != F.col("cell")) | (F.col("id_a") < F.col("id_b"))))
    met = met.withColumn("distance_m", great_circle_m(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))).filter(F.col("distance_m") <= radius_m)
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "distance_m").groupBy("id_a", "id_b").agg(F.min("distance_m").alias("distance_m"))


def _inside(lat: Column, lng: Column, ring: Column) -> Column:
    """Even-odd rule over a ring of ``struct<lat,lng>``; a point on the southern or western edge counts as inside."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(ring, i).alias("p"), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1)).alias("q")))
    crosses = lambda e: ((e.p.lat > lat) != (e.q.lat > lat)) & (lng < (e.q.lng - e.p.lng) * (lat - e.p.lat) / F.when(e.q.lat == e.p.lat, None).otherwise(e.q.lat - e.p.lat) + e.p.lng)
    return F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def regions_of(points: DataFrame, regions: DataFrame, id_col: str, lat_col: str, lng_col: str, region_col: str, ring_col: str, cell_degrees: float = 0.25, hot_cell: int = HOT_CELL) -> DataFrame:
    """The regions that contain each point: ``id``, ``region`` (null where there is none).

    ``ring_col`` holds a polygon as ``array<struct<lat double, lng double>>``,
    which mustn't cross the antimeridian. Points without a coordinate get one
    row with a null region; a point in several regions gets one row for each;
    null or short rings (under three corners) contain nothing; repeated rows
    give one. Regions are laid out over the cells their bounding box touches
    and meet points by an equality join on the cell; the points of cells that hold more
    than ``hot_cell`` are dealt to several tasks.
    """
    key = points.select(F.col(id_col).alias("id"), F.col(lat_col).cast("double").alias("lat"), F.col(lng_col).cast("double").alias("lng")).distinct()
    good = key.filter(is_coordinate(F.col("lat"), F.col("lng")))
    floor = lambda x: F.floor(x / cell_degrees).cast("int")
    good = good.withColumn("row", floor(F.col("lat"))).withColumn("column", floor(F.col("lng")))
    lats, lngs = F.transform(ring_col, lambda c: c.lat), F.transform(ring_col, lambda c: c.lng)
    laid = regions.filter(F.size(ring_col) >= 3).select(
        F.col(region_col).alias("region"), F.col(ring_col).alias("ring"), lngs.alias("lngs"), F.explode(F.sequence(floor(F.array_min(lats)), floor(F.array_max(lats)))).alias("row")
    )
    laid = laid.select("region", "ring", "row", F.explode(F.sequence(floor(F.array_min("lngs")), floor(F.array_max("lngs")))).alias("column"))
    found = salted_join(laid, cut(good), ["row", "column"], hot_cell).filter(_inside(F.col("lat"), F.col("lng"), F.col("ring"))).select("id", "region").distinct()
    return key.select("id").distinct().join(found, "id", "left")
