"""Places by kind, nearest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions import geo
from lakeworks.functions.text import any_ilike, any_like


def competitors(
    places: DataFrame, amenities: list[str], names: list[str], cuisines: list[str]
) -> DataFrame:
    """Places of given kinds with a matching name, or with a matching cuisine of any kind."""
    by_name = F.col("amenity").isin(amenities) & any_ilike(F.col("name"), names)
    return places.filter(by_name | any_like(F.col("cuisine"), cuisines))


def shops_of_kind(places: DataFrame, kind: str) -> DataFrame:
    return places.filter(F.col("shop") == F.lit(kind))


def nearest_first(
    places: DataFrame, lng: float | str, lat: float | str, as_name: str, tie: list[str]
) -> DataFrame:
    """Places with their distance to a fixed point, ascending; ``tie`` fixes equal distances."""
    measured = places.withColumn(as_name, geo.distance_to(lng, lat, F.col("coordinates")))
    return measured.orderBy(as_name, *tie)


def wkt_of(places: DataFrame, as_name: str = "wkt") -> DataFrame:
    return places.withColumn(as_name, geo.to_wkt(F.array("coordinates")))
