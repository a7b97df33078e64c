"""Stored results of a per-file computation, refreshed where their files changed.

A manifest lists path, length and modification time of every source file behind the
stored result, and the generation that computed it.  A refresh compares the listing
with the manifest, computes new and changed files alone into a new generation, and
publishes the next manifest.  Readers follow the newest manifest, so they see a
refresh as a whole; a refresh that fails leaves files nobody reads.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators import storage
from lakeworks.operators.joins import restrict_to_keys
from lakeworks.session import cut_lineage

_MANIFEST = "file_url string, size bigint, last_modified timestamp, generation bigint"


def manifest(spark: SparkSession, stored: str) -> DataFrame:
    """Source files behind the stored result; empty before the first refresh."""
    if not storage.versions(spark, f"{stored}/manifest"):
        return spark.createDataFrame([], _MANIFEST)
    return storage.read(spark, f"{stored}/manifest")


def refresh(listing: DataFrame, stored: str, compute: Callable[[list[str]], DataFrame]) -> dict[str, int]:
    """Bring the stored result up to date; the numbers of computed, kept and removed files.

    ``listing`` has file_url, size and last_modified, as
    :func:`lakeworks.sources.files.list_files` gives them.  ``compute`` gets the
    paths of changed files and returns rows with a column ``file_url``.  One
    refresh at a time.
    """
    spark = listing.sparkSession
    fields = ["file_url", "size", "last_modified"]
    now, then = cut_lineage(listing.select(*fields), "listing"), manifest(spark, stored)
    kept = cut_lineage(now.join(then, fields), "kept")
    changed = now.join(kept.select("file_url"), "file_url", "left_anti")
    paths = [unquote(r["file_url"]) for r in changed.select("file_url").toLocalIterator()]
    generation = max(storage.versions(spark, f"{stored}/manifest"), default=0) + 1
    removed = then.join(now.select("file_url"), "file_url", "left_anti").count()
    if paths:
        target = f"{stored}/rows/_generation={generation}"
        compute(paths).write.mode("overwrite").parquet(target)
    if paths or removed:
        added = changed.select(*fields, F.lit(generation).cast("bigint").alias("generation"))
        storage.publish(kept.select(*fields, "generation").unionByName(added), f"{stored}/manifest")
    return {"computed": len(paths), "kept": kept.count(), "removed": removed}


def read(spark: SparkSession, stored: str) -> DataFrame:
    """Rows of the newest refresh."""
    live = manifest(spark, stored).select(F.col("file_url"), F.col("generation").alias("_generation"))
    generations = [r["_generation"] for r in live.select("_generation").distinct().collect()]
    if not generations:
        raise FileNotFoundError(f"nothing was stored below {stored}")
    folders = [f"{stored}/rows/_generation={g}" for g in sorted(generations)]
    rows = spark.read.option("basePath", f"{stored}/rows").parquet(*folders)
    return restrict_to_keys(rows, live, ["file_url", "_generation"]).drop("_generation")
