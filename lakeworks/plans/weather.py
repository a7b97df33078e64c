"""Weather history and forecast restricted to the postal codes of a mailing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.joins import restrict_to_keys


def mailing_codes(history: DataFrame, country: str, first: str, second: str) -> DataFrame:
    """Distinct postal codes by pattern.

    The country applies to the first pattern only: AND binds closer than OR,
    and that reading is kept.
    """
    code = F.col("postal_code")
    wanted = ((F.col("country") == country) & code.like(first)) | code.like(second)
    return history.filter(wanted).select("postal_code").distinct()


def counts_before_and_after(history: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows of the whole history and of the mailing's share."""
    kept = restrict_to_keys(history.select("postal_code"), codes, "postal_code")
    whole = history.agg(F.count("*").alias("n_rows")).withColumn("scope", F.lit("all"))
    share = kept.agg(F.count("*").alias("n_rows")).withColumn("scope", F.lit("mailing"))
    return whole.unionByName(share).select("scope", "n_rows")


def rows_for_codes(history: DataFrame, codes: DataFrame) -> DataFrame:
    kept = restrict_to_keys(history.select("postal_code"), codes, "postal_code")
    return kept.agg(F.count("*").alias("n_rows"))


def date_span(forecast: DataFrame, codes: DataFrame) -> DataFrame:
    kept = restrict_to_keys(forecast.select("postal_code", "date_valid_std"), codes, "postal_code")
    return kept.agg(
        F.max("date_valid_std").alias("last_day"), F.min("date_valid_std").alias("first_day")
    )


def cloud_cover_per_day(forecast: DataFrame, codes: DataFrame) -> DataFrame:
    """Average cloud cover per day, clearest days first."""
    kept = restrict_to_keys(forecast, codes, "postal_code")
    cover = F.avg("avg_cloud_cover_tot_pct").alias("avg_cloud_cover")
    return kept.groupBy("date_valid_std").agg(cover).orderBy("avg_cloud_cover", "date_valid_std")
