"""Fewer files in a merge target, while its stream goes on.

Every micro-batch adds files to the days it touches.  A compaction rewrites the
folders of finished batches day by day into one folder a day, with files of about
``file_bytes``, and then publishes a record that names the new folders as live and
the old ones as replaced.  :func:`lakeworks.streaming.pipeline.read_target` follows
the newest record, so that a reader, and the next batch, see either the old folders
or the new one.

The newest batch of a run may still be tried again by its stream, and a catch-up may
be repeated, so neither is touched.  What a compaction wrote counts only once its
record is published; replaced folders are deleted only after that.  A compaction
killed at any point therefore loses and repeats no row: the next one replaces what it
left behind.  One compaction of a target at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators import storage
from lakeworks.operators.joins import sized_lookup
from lakeworks.session import cut_lineage
from lakeworks.streaming.pipeline import BATCH, COMPACTED, DAY, NO_DAY, RUN, exists, generations_of, read_target

FILE_BYTES = 128 * 1024 * 1024
#: A day with fewer replaceable folders stays as it is.
LEAST_FOLDERS = 2

_FOLDER = rf"/{DAY}=([^/]+)/{RUN}=([^/]+)/{BATCH}=(\d+)/"
_RECORD = f"{DAY} date, {RUN} string, {BATCH} bigint, live boolean"


def folders(spark: SparkSession, target: str) -> DataFrame:
    """Folders of the target with files in them: day, run, batch, bytes."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(target)
    path = F.col("path")
    day = F.regexp_extract(path, _FOLDER, 1)
    return (
        listing.filter(path.rlike(_FOLDER))
        .groupBy(
            F.when(day != NO_DAY, day).cast("date").alias(DAY),
            F.regexp_extract(path, _FOLDER, 2).alias(RUN),
            F.regexp_extract(path, _FOLDER, 3).cast("bigint").alias(BATCH),
        )
        .agg(F.sum("length").alias("bytes"))
    )


def _record(spark: SparkSession, target: str) -> DataFrame:
    if not storage.versions(spark, generations_of(target)):
        return spark.createDataFrame([], _RECORD)
    return storage.read(spark, generations_of(target))


def _same(left: str, right: str) -> object:
    same = F.lit(True)
    for column in (DAY, RUN, BATCH):
        same = same & F.col(f"{left}.{column}").eqNullSafe(F.col(f"{right}.{column}"))
    return same


def compact(
    spark: SparkSession, target: str, schema: T.StructType, file_bytes: int = FILE_BYTES, least_folders: int = LEAST_FOLDERS
) -> int:
    """Rewrite the finished batches of every day that has several; the number of folders replaced."""
    if not exists(spark, target):
        return 0
    record = _record(spark, target)
    known = F.col("r.live")
    counts = F.coalesce(known, ~F.col(f"f.{RUN}").startswith(COMPACTED))
    present = cut_lineage(
        folders(spark, target).alias("f").join(record.alias("r"), _same("f", "r"), "left").select("f.*", counts.alias("live")), "folders"
    )
    newest = F.max(BATCH).over(Window.partitionBy(RUN))
    settled = (F.col(BATCH) < newest) & ~F.col(RUN).startswith("catchup-") | F.col(RUN).startswith(COMPACTED)
    ready = present.withColumn("_settled", settled).filter("live AND _settled")
    per_day = Window.partitionBy(DAY)
    chosen = ready.withColumn("_n", F.count("*").over(per_day)).withColumn("_bytes", F.sum("bytes").over(per_day))
    chosen = cut_lineage(chosen.filter(F.col("_n") >= least_folders).select(DAY, RUN, BATCH, "_bytes"), "chosen")
    n_chosen = chosen.count()
    generation = max(storage.versions(spark, generations_of(target)), default=0) + 1
    run = f"{COMPACTED}{generation:010d}"
    if n_chosen:
        parts = F.greatest(F.ceil(F.col("_bytes") / file_bytes), F.lit(1))
        n_files = chosen.select(DAY, parts.alias("n")).distinct().agg(F.sum("n")).first()[0]
        rows = read_target(spark, target, schema).alias("t").join(sized_lookup(chosen).alias("c"), _same("t", "c"))
        # a day's rows are dealt over as many files as its bytes need
        dealt = rows.select("t.*", F.pmod(F.xxhash64(*[f"t.`{n}`" for n in schema.fieldNames()]), parts).alias("_file"))
        written = dealt.repartition(n_files, DAY, "_file").drop("_file").withColumns({RUN: F.lit(run), BATCH: F.lit(0).cast("bigint")})
        written.write.partitionBy(DAY, RUN, BATCH).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)
    live = chosen.select(DAY).distinct().select(DAY, F.lit(run).alias(RUN), F.lit(0).cast("bigint").alias(BATCH), F.lit(True).alias("live"))
    gone = chosen.select(DAY, RUN, BATCH, F.lit(False).alias("live"))
    # folders named before that are still there keep their state, unless they were replaced now
    carried = present.filter("live OR " + RUN + " NOT LIKE '" + COMPACTED + "%'").alias("p").join(record.alias("r"), _same("p", "r"))
    carried = carried.select("r.*").alias("o").join(gone.alias("g"), _same("o", "g"), "left_anti")
    if n_chosen:
        storage.publish(cut_lineage(carried.unionByName(gone).unionByName(live), "record"), generations_of(target))
    _delete_replaced(spark, target, present)
    return n_chosen


def _delete_replaced(spark: SparkSession, target: str, present: DataFrame) -> None:
    """Delete the folders of ``present`` that the newest record does not count."""
    record = _record(spark, target)
    counts = F.coalesce(F.col("r.live"), ~F.col(f"p.{RUN}").startswith(COMPACTED))
    dead = present.alias("p").join(record.alias("r"), _same("p", "r"), "left").filter(~counts)
    for row in dead.select("p.*").toLocalIterator():
        day = row[DAY].isoformat() if row[DAY] else NO_DAY
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{DAY}={day}/{RUN}={row[RUN]}/{BATCH}={row[BATCH]}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
