"""Files as rows, and where each row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeworks.functions.temporal import load_second
from lakeworks.operators.joins import sized_lookup


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``folder``; the contents are never read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return listing.select(
        F.substring("path", len(root) + 2, 1 << 20).alias("relative_path"),
        F.col("_metadata.file_path").alias("file_url"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def rows_per_file(df: DataFrame, as_name: str = "n_rows") -> DataFrame:
    """Row count of every file behind a file-based DataFrame.

    Files are told apart by their URL; names may repeat across folders.
    """
    url, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    return df.groupBy(url.alias("file_url"), name.alias("file_name")).agg(F.count("*").alias(as_name))


def with_file_name(df: DataFrame, as_name: str = "file_name") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.select("*", F.col("_metadata.file_name").alias(as_name))


def with_row_numbers(df: DataFrame) -> DataFrame:
    """Add ``file_name`` and the 1-based ``file_row`` of rows read straight from files.

    A file is read in pieces, each in order.  Only the number of rows per piece
    is gathered and summed up; the rows themselves are not moved.  ``df`` must
    be a plain file read, whose pieces are the same each time it runs.
    """
    tagged = df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    pieces = tagged.groupBy("_file", "_start").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_file",
        "_start",
        "_first",
        "_n",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    joined = tagged.join(sized_lookup(offsets), ["_file", "_start"], "left")
    # a row outside the piece that was counted means that the two scans were cut differently
    known = F.col("_at").between(F.col("_first"), F.col("_first") + F.col("_n") - 1)
    lost = F.raise_error(F.lit("with_row_numbers: the files were read in other pieces when they were counted"))
    number = F.when(F.coalesce(known, F.lit(False)), F.col("_at") + F.col("_shift") + 1).otherwise(lost)
    return joined.withColumn("file_row", number).drop("_file", "_start", "_at", "_shift", "_first", "_n")


def provenance(file_name: Column, row_id: Column) -> list[Column]:
    """The three columns that tell where and when a row was loaded."""
    return [
        file_name.alias("log_file_name"),
        row_id.cast("bigint").alias("log_file_row_id"),
        load_second().alias("load_ltz"),
    ]
