"""Nations, regions, segments and country codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.aggregates import filled_per_group, group_counts
from lakeworks.operators.joins import lookup_join


def nations_with_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Region and nation names, sorted."""
    joined = lookup_join(nation, region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation")).orderBy(
        "region", "nation"
    )


def countries_per_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    joined = lookup_join(nation, region, F.col("n_regionkey") == F.col("r_regionkey"))
    return filled_per_group(
        joined.select(F.col("r_name").alias("region"), "n_name"), ["region"], "n_name", "num_countries"
    )


def segment_counts(customer: DataFrame) -> DataFrame:
    return group_counts(customer, ["c_mktsegment"], "n_customers")


def countries_with_region(iso: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Country codes with the region of the nation of the same name; unknown ones kept."""
    named = lookup_join(
        iso, nation, F.upper("iso_country_name") == F.col("n_name"), "left"
    )
    placed = lookup_join(named, region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return placed.select(
        "iso_country_name",
        "country_name_official",
        "alpha_code_2digit",
        F.col("r_name").alias("region"),
    )


def simple_currency(country_currency: DataFrame) -> DataFrame:
    """Country and currency codes only."""
    return country_currency.select(
        F.col("country_char_code").alias("cty_code"), F.col("currency_char_code").alias("cur_code")
    )
