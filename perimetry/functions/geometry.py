"""Polygon expressions on nested arrays (see ``schema.GEOM``); everything here stays in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sphere radius of the web mercator projection, metres.
MERCATOR_RADIUS = 6378137.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(points: Column) -> Column:
    """A geometry of one polygon with one ring."""
    return F.array(F.array(points))


def all_points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def is_empty(geom: Column) -> Column:
    """True where a geometry has no point at all; null for a missing geometry."""
    return F.size(all_points(geom)) == 0


def bbox(geom: Column) -> Column:
    """``struct<xmin,ymin,xmax,ymax>``; null for a missing or empty geometry."""
    points = all_points(geom)
    x, y = points.getField("x"), points.getField("y")
    box = F.struct(
        F.array_min(x).alias("xmin"),
        F.array_min(y).alias("ymin"),
        F.array_max(x).alias("xmax"),
        F.array_max(y).alias("ymax"),
    )
    return F.when(F.size(points) > 0, box)


def bboxes_meet(a: Column, b: Column) -> Column:
    """Closed overlap of two boxes: a shared side or corner counts."""
    return (
        (a["xmin"] <= b["xmax"])
        & (b["xmin"] <= a["xmax"])
        & (a["ymin"] <= b["ymax"])
        & (b["ymin"] <= a["ymax"])
    )


def point_text(p: Column) -> Column:
    """``POINT (x y)``, or ``NOGEOM`` where there is no point."""
    text = F.format_string("POINT (%s %s)", p["x"], p["y"])
    return F.when(p.isNull(), "NOGEOM").otherwise(text)


def _map_points(geom: Column, change) -> Column:
    return F.transform(geom, lambda part: F.transform(part, lambda ring: F.transform(ring, change)))


def mercator_to_degrees(geom: Column) -> Column:
    """EPSG:3857 metres to EPSG:4326 degrees (closed form)."""

    def unproject(p: Column) -> Column:
        lon = F.degrees(p["x"] / MERCATOR_RADIUS)
        lat = F.degrees(2 * F.atan(F.exp(p["y"] / MERCATOR_RADIUS)) - math.pi / 2)
        return point(lon, lat)

    return _map_points(geom, unproject)


def to_wgs84(geom: Column, srid: Column, nad83_as_wgs84: bool = False) -> Column:
    """Geometry in EPSG:4326. An undeclared system counts as 4326; an unsupported one gives null."""
    same = srid.isNull() | srid.isin(*([4326, 4269] if nad83_as_wgs84 else [4326]))
    return F.when(same, geom).when(srid == 3857, mercator_to_degrees(geom))


def wgs84_srid(srid: Column, nad83_as_wgs84: bool = False) -> Column:
    """The system that ``to_wgs84`` leaves a geometry in: 4326, or the source's where it cannot convert it."""
    known = srid.isNull() | srid.isin(*([4326, 4269, 3857] if nad83_as_wgs84 else [4326, 3857]))
    return F.when(known, F.lit(4326)).otherwise(srid)


def degrees_to_mercator(geom: Column) -> Column:
    """EPSG:4326 degrees to EPSG:3857 metres (closed form)."""

    def project(p: Column) -> Column:
        x = MERCATOR_RADIUS * F.radians(p["x"])
        return point(x, MERCATOR_RADIUS * F.log(F.tan(math.pi / 4 + F.radians(p["y"]) / 2)))

    return _map_points(geom, project)
