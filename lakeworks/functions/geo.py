"""Points, trails and distances on a sphere, as Column arithmetic.

A point is ``struct<lng:double, lat:double>``; a trail is an array of points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in metres.
EARTH_RADIUS_M = 6371008.8


def make_point(lng: Column | float | str, lat: Column | float | str) -> Column:
    """Point from longitude and latitude; numbers may arrive as text."""
    return F.struct(_number(lng).alias("lng"), _number(lat).alias("lat"))


def _number(value: Column | float | str) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("double")


def distance(a: Column, b: Column) -> Column:
    """Great-circle distance of two points in metres."""
    lat_a, lat_b = F.radians(a["lat"]), F.radians(b["lat"])
    half_lat = F.sin((lat_b - lat_a) / 2)
    half_lng = F.sin((F.radians(b["lng"]) - F.radians(a["lng"])) / 2)
    chord = half_lat * half_lat + F.cos(lat_a) * F.cos(lat_b) * half_lng * half_lng
    # rounding may push the chord of opposite points above 1; NULL has to stay NULL
    bounded = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(bounded))


def distance_to(lng: float | str, lat: float | str, *place: Column) -> Column:
    """Distance to a fixed point, from one point column or from two coordinate columns."""
    here = place[0] if len(place) == 1 else make_point(*place)
    return distance(make_point(lng, lat), here)


def coordinate(value: Column | str) -> Column:
    """Coordinate with 8 decimals, millimetre precision."""
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(11,8)")


def coordinate_pair(lng: Column, lat: Column) -> Column:
    """``lng lat`` text."""
    return F.concat(lng.cast("string"), F.lit(" "), lat.cast("string"))


def point_wkt(pair: Column) -> Column:
    return F.concat(F.lit("POINT("), pair, F.lit(")"))


def linestring_wkt(pairs: Column) -> Column:
    """WKT from comma-separated coordinate pairs."""
    return F.concat(F.lit("LINESTRING("), pairs, F.lit(")"))


def linestring_geojson(pairs: Column) -> Column:
    """GeoJSON geometry from comma-separated ``[lng,lat]`` texts."""
    return F.concat(F.lit('{"coordinates":['), pairs, F.lit('],"type":"LineString"}'))


def json_pair(lng: Column, lat: Column) -> Column:
    return F.concat(F.lit("["), lng.cast("string"), F.lit(","), lat.cast("string"), F.lit("]"))


def from_geojson(text: Column | str) -> Column:
    """Trail from a GeoJSON LineString (or a one-point trail from a Point)."""
    line = F.from_json(text, "coordinates array<array<double>>")["coordinates"]
    point = F.from_json(text, "coordinates array<double>")["coordinates"]
    kind = F.get_json_object(text, "$.type")
    return F.when(
        kind == "LineString",
        F.transform(line, lambda p: make_point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))),
    ).when(kind == "Point", F.array(make_point(F.get(point, F.lit(0)), F.get(point, F.lit(1)))))


def from_wkt(text: Column | str) -> Column:
    """Trail from WKT ``LINESTRING(...)`` or ``POINT(...)``."""
    value = F.col(text) if isinstance(text, str) else text
    inner = F.regexp_extract(value, r"^\s*(?:LINESTRING|POINT)\s*\(([^()]*)\)\s*$", 1)
    pairs = F.transform(F.split(inner, ","), lambda p: F.split(F.trim(p), r"\s+"))
    points = F.transform(
        pairs,
        lambda p: F.struct(
            F.get(p, F.lit(0)).try_cast("double").alias("lng"),
            F.get(p, F.lit(1)).try_cast("double").alias("lat"),
        ),
    )
    return F.when(inner != "", points)


def to_wkt(trail: Column) -> Column:
    """Text of a trail: POINT for one point, LINESTRING for more."""
    pairs = F.array_join(
        F.transform(
            trail,
            lambda p: F.concat(p["lng"].cast("string"), F.lit(" "), p["lat"].cast("string")),
        ),
        ",",
    )
    return F.when(F.size(trail) == 1, point_wkt(pairs)).when(
        F.size(trail) > 1, linestring_wkt(pairs)
    )


def length(trail: Column) -> Column:
    """Sum of leg distances in metres; a single point has length 0."""
    tail = F.slice(trail, F.lit(2), F.greatest(F.size(trail) - 1, F.lit(0)))
    head = F.slice(trail, F.lit(1), F.greatest(F.size(trail) - 1, F.lit(0)))
    legs = F.zip_with(head, tail, distance)
    return F.when(
        F.size(trail) > 0, F.aggregate(legs, F.lit(0.0), lambda total, leg: total + leg)
    )


def x_min(trail: Column) -> Column:
    return F.array_min(F.transform(trail, lambda p: p["lng"]))


def x_max(trail: Column) -> Column:
    return F.array_max(F.transform(trail, lambda p: p["lng"]))


def y_min(trail: Column) -> Column:
    return F.array_min(F.transform(trail, lambda p: p["lat"]))


def y_max(trail: Column) -> Column:
    return F.array_max(F.transform(trail, lambda p: p["lat"]))


def box_wkt(
    west: Column, east: Column, south: Column, north: Column, closed: bool = False
) -> Column:
    """Bounding polygon from its corners, clockwise from the north-west.

    The ring is left open unless ``closed`` asks for the repeated first corner.
    """
    def corner(x: Column, y: Column) -> Column:
        return F.concat(x.cast("string"), F.lit(" "), y.cast("string"))

    ring = [corner(west, north), corner(east, north), corner(east, south), corner(west, south)]
    if closed:
        ring.append(ring[0])
    text = ring[0]
    for point in ring[1:]:
        text = F.concat(text, F.lit(","), point)
    return F.concat(F.lit("POLYGON(("), text, F.lit("))"))
