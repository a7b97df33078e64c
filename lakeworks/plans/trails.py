"""Trails from point files and from GeoJSON, with bounds and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.functions import geo
from lakeworks.functions.variants import path
from lakeworks.operators.aggregates import ordered_text
from lakeworks.operators.ordering import GROUP_ROWS, with_next

#: Points of a trail sorted together before the pieces are joined.
STRETCH_POINTS = 100_000


def trail_points(raw: DataFrame) -> DataFrame:
    """Clean points.

    The raw ``latitude`` holds the longitude and the other way round; the names
    are put right here.
    """
    lng, lat = geo.coordinate("latitude"), geo.coordinate("longitude")
    return raw.select(
        F.col("sequence_1").cast("bigint").alias("point_id"),
        F.col("trail_name").cast("string").alias("trail_name"),
        lng.alias("lng"),
        lat.alias("lat"),
        geo.coordinate_pair(lng, lat).alias("coord_pair"),
    )


def points_wkt(points: DataFrame) -> DataFrame:
    """Each point as coordinate pair and as WKT."""
    return points.select(
        "point_id", "coord_pair", geo.point_wkt(F.col("coord_pair")).alias("trail_point")
    )


def _along(points: DataFrame, text: Column, as_name: str) -> DataFrame:
    return ordered_text(
        points,
        ["trail_name"],
        text,
        ",",
        as_name,
        order=F.col("point_id"),
        stretch=F.floor(F.col("point_id") / STRETCH_POINTS),
    )


def linestrings(points: DataFrame) -> DataFrame:
    """WKT line of every trail."""
    joined = _along(points, F.col("coord_pair"), "_pairs")
    return joined.select("trail_name", geo.linestring_wkt(F.col("_pairs")).alias("my_linestring"))


def trails_from_points(points: DataFrame) -> DataFrame:
    """Feature name, GeoJSON geometry and length of every trail of a point table."""
    pairs = geo.json_pair(F.col("lng"), F.col("lat"))
    shaped = _along(points, pairs, "_pairs").select(
        F.col("trail_name").alias("feature_name"),
        geo.linestring_geojson(F.col("_pairs")).alias("geometry"),
    )
    return shaped.withColumn("trail_length", geo.length(geo.from_geojson("geometry")))


def trails_from_documents(documents: DataFrame, document: str = "whole_object") -> DataFrame:
    """The same columns from GeoJSON feature collections, one trail per document."""
    return documents.select(
        path(document, "features[0].properties.Name").alias("feature_name"),
        path(document, "features[0].geometry.coordinates").alias("feature_coordinates"),
        path(document, "features[0].geometry").alias("geometry"),
        path(document, "features[0].properties").alias("feature_properties"),
        path(document, "crs.properties.name").alias("specs"),
        F.col(document).alias("whole_object"),
    ).withColumn("trail_length", geo.length(geo.from_geojson("geometry")))


def all_trails(*sources: DataFrame) -> DataFrame:
    """Trails of several sources under each other, repeats kept."""
    columns = ["feature_name", "geometry", "trail_length"]
    first, *rest = [s.select(*columns) for s in sources]
    for other in rest:
        first = first.unionByName(other)
    return first


def boundaries(trails: DataFrame) -> DataFrame:
    """West, east, south and north end of every trail."""
    line = F.col("my_linestring")
    return trails.withColumn("my_linestring", geo.from_geojson("geometry")).select(
        "feature_name",
        "my_linestring",
        geo.x_min(line).alias("min_eastwest"),
        geo.x_max(line).alias("max_eastwest"),
        geo.y_min(line).alias("min_northsouth"),
        geo.y_max(line).alias("max_northsouth"),
        "trail_length",
    )


def boundaries_from_points(points: DataFrame) -> DataFrame:
    """The same columns but the line, straight from the points: no trail is gathered as a whole."""
    bounds = points.groupBy("trail_name").agg(
        F.min("lng").alias("min_eastwest"),
        F.max("lng").alias("max_eastwest"),
        F.min("lat").alias("min_northsouth"),
        F.max("lat").alias("max_northsouth"),
    )
    lengths = trail_lengths(points).select(F.col("trail_name").alias("_trail"), "trail_length")
    return bounds.join(lengths, F.col("trail_name").eqNullSafe(F.col("_trail"))).select(
        F.col("trail_name").alias("feature_name"),
        "min_eastwest",
        "max_eastwest",
        "min_northsouth",
        "max_northsouth",
        "trail_length",
    )


def bounding_polygon(bounds: DataFrame, closed: bool = False) -> DataFrame:
    """Polygon around all trails."""
    edges = bounds.agg(
        F.min("min_eastwest").alias("west"),
        F.max("max_eastwest").alias("east"),
        F.min("min_northsouth").alias("south"),
        F.max("max_northsouth").alias("north"),
    )
    corners = [F.col(c) for c in ("west", "east", "south", "north")]
    return edges.select(geo.box_wkt(*corners, closed=closed).alias("my_polygon"))


def trail_lengths(points: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Length of every trail straight from its points.

    No trail is gathered as a whole: each point is paired with the next one,
    and the legs are added up where they are before the sums are shuffled.
    """
    slim = points.select("trail_name", "point_id", "lng", "lat")
    paired = with_next(
        slim, ["trail_name"], "point_id", {"_lng": "lng", "_lat": "lat"}, F.col("point_id"), group_rows
    )
    leg = geo.distance(
        geo.make_point(F.col("lng"), F.col("lat")), geo.make_point(F.col("_lng"), F.col("_lat"))
    )
    return paired.groupBy("trail_name").agg(
        F.coalesce(F.sum(leg), F.lit(0.0)).alias("trail_length"), F.count("*").alias("n_points")
    )


def with_distance(points: DataFrame, lng: float, lat: float, as_name: str) -> DataFrame:
    """Points with their distance to a fixed place; write the result once and query it often."""
    return points.withColumn(as_name, geo.distance_to(lng, lat, F.col("lng"), F.col("lat")))
