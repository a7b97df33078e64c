"""Parquet tables, read in place."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A read-only Parquet table of a shared folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def project_cast(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Pick and cast columns: ``{new name: (column, type)}``; only those columns are read."""
    return df.select(*[F.col(c).cast(t).alias(name) for name, (c, t) in fields.items()])


#: Column that names the file a row of an external table comes from.
FILE_NAME = "my_filename"


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Catalog table over Parquet files that stay where they are, plus their file name."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path, "parquet")
    return spark.table(name).select("*", F.col("_metadata.file_name").alias(FILE_NAME))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], **columns: str) -> DataFrame:
    """Rows written out in the program, as literals inside the plan."""
    text = json.dumps([dict(zip(columns, row)) for row in rows])
    fields = ", ".join(f"{name}: {kind}" for name, kind in columns.items())
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))
