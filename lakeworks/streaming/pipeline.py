"""Files to table, table to enriched table, each row once.

Two Structured Streaming queries.  The first appends new files to a landing
table; the second takes new landing rows, enriches them and inserts those the
target lacks.  What has been consumed is recorded in the checkpoints; both
queries can be stopped, killed and started again at any time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from lakeworks.functions.variants import get_key
from lakeworks.operators import storage
from lakeworks.operators.joins import BROADCAST_BYTES, measured_bytes, sized_lookup
from lakeworks.operators.tables import rows_to_insert
from lakeworks.schemas import struct
from lakeworks.sources.documents import file_values, rejected_files
from lakeworks.sources.files import provenance

#: Schema of the landing table.
LANDING = struct(
    log_file_name="string",
    log_file_row_id="bigint",
    load_ltz="timestamp",
    datetime_iso8601="timestamp_ntz",
    user_event="string",
    user_login="string",
    ip_address="string",
)

DAY, RUN, BATCH = "_day", "_run", "_batch"


def log_rows(files: DataFrame) -> DataFrame:
    """Landing rows from whole-file texts (batch or stream); files that are not JSON give none, see ``rejects``."""
    docs = files.select(F.col("_metadata.file_name").alias("_name"), "value")
    rows = docs.select("_name", F.posexplode(file_values(F.col("value"))).alias("_pos", "_raw"))
    return rows.select(
        *provenance(F.col("_name"), F.col("_pos") + 1),
        get_key("_raw", "datetime_iso8601", "timestamp_ntz").alias("datetime_iso8601"),
        get_key("_raw", "user_event").alias("user_event"),
        get_key("_raw", "user_login").alias("user_login"),
        get_key("_raw", "ip_address").alias("ip_address"),
    )


def start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Start a query: once over all pending data, or again ``every`` interval."""
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def ingest_files(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    every: str | None = None,
    purge: bool = False,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Append rows of new files to the landing table, each file once.

    ``purge`` moves a file out of the source once it was read, to
    :func:`archive_of` the checkpoint; :func:`purge_archive` then deletes the
    files that were JSON.  A file that was not is kept there and listed by
    :func:`rejects`.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if purge:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_of(checkpoint))
    writer = (
        log_rows(reader.text(source, wholetext=True))
        .writeStream.format("parquet")
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, every)


def archive_of(checkpoint: str) -> str:
    """Where files go that were read with ``purge``."""
    return f"{checkpoint.rstrip('/')}-read-files"


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a source or archive folder that are not JSON, with their text."""
    return rejected_files(spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True))


def purge_archive(spark: SparkSession, checkpoint: str) -> int:
    """Delete the archived files that were JSON; the number deleted.  Rejected files stay."""
    archive = archive_of(checkpoint)
    if not exists(spark, archive):
        return 0
    texts = spark.read.option("recursiveFileLookup", True).text(archive, wholetext=True)
    path = F.col("_metadata.file_path").alias("path")
    deleted = 0
    for row in texts.select(path, file_values(F.col("value")).isNotNull().alias("read")).filter("read").toLocalIterator():
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["path"]))
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, False)
        deleted += 1
    return deleted


def changes(
    spark: SparkSession, landing: str, schema: T.StructType = LANDING, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of rows added to a landing table since its checkpoint, ``files_per_batch`` files at a time.

    How the rows are cut into batches matters for repeats: rows with one key are
    all inserted if they come in the same batch, and only the first batch's are
    if they come in several.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


#: Folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_target(
    spark: SparkSession, target: str, schema: T.StructType, days: list[str] | None = None
) -> DataFrame:
    """Inserted rows, with the day, run and batch of their folder.

    With ``days`` only their folders and that of rows without a day are listed
    and read.  Folders that :mod:`lakeworks.streaming.compaction` has replaced are
    left out.
    """
    added = [T.StructField(DAY, T.DateType()), T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
    full = T.StructType([*schema.fields, *added])
    paths = [target] if days is None else [f"{target}/{DAY}={day}" for day in [*days, NO_DAY]]
    paths = [path for path in paths if exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], full).limit(0)
    return live_rows(spark.read.schema(full).option("basePath", target).parquet(*paths), target)


def generations_of(target: str) -> str:
    """Where the compactions of a target are recorded."""
    return f"{target.rstrip('/')}-generations"


#: Runs of this name hold what a compaction wrote.
COMPACTED = "compacted-"


def live_rows(rows: DataFrame, target: str) -> DataFrame:
    """Rows without those of folders that a published compaction replaced, or that an unpublished one wrote.

    The newest record says for each folder it names whether it counts.  A folder
    of a compaction counts only if it is named, any other one unless it is named
    as replaced.
    """
    spark = rows.sparkSession
    if not storage.versions(spark, generations_of(target)):
        return rows.filter(~F.col(RUN).startswith(COMPACTED))
    named = storage.read(spark, generations_of(target))
    same = F.lit(True)
    for column in (DAY, RUN, BATCH):
        same = same & F.col(column).eqNullSafe(F.col(f"_named{column}"))
    known = named.select(*[F.col(c).alias(f"_named{c}") for c in (DAY, RUN, BATCH)], F.col("live").alias("_live"))
    counts = F.coalesce("_live", ~F.col(RUN).startswith(COMPACTED))
    return rows.join(sized_lookup(known), same, "left").filter(counts).select(*rows.columns)


def insert_batch(
    rows: DataFrame,
    target: str,
    schema: T.StructType,
    on: dict[str, str],
    run: str,
    batch: int,
    prune_by: str | None = None,
) -> None:
    """Insert the rows the target lacks into the folders of their day, this run and batch.

    The batch's folders are overwritten, and their former content is not counted
    as target, so a batch tried again after a failure gives the same rows.
    ``prune_by`` names the target key that holds the event time: rows are filed
    by its day, and as equal keys have equal days, only the folders of the
    batch's own days are listed and read, however large the target has grown.
    Within them the scan skips row groups outside the batch's time span.  If the
    batch is measured small, its keys filter the target where it is read, and a
    large target is not shuffled for a small batch.
    """
    spark = rows.sparkSession
    keys = rows.select(*[F.col(s).alias(t) for t, s in on.items()])
    days = None
    if prune_by:
        listed = keys.select(F.to_date(prune_by).cast("string").alias("day")).filter("day is not null").distinct()
        days = sorted(r["day"] for r in listed.collect())
    present = read_target(spark, target, schema, days).filter(
        ~((F.col(RUN) == run) & (F.col(BATCH) == batch))
    )
    if prune_by:
        batch_is = keys.agg(F.min(prune_by).alias("low"), F.max(prune_by).alias("high")).first()
        present = present.filter(
            F.col(prune_by).between(F.lit(batch_is["low"]), F.lit(batch_is["high"]))
        )
    if measured_bytes(keys) <= BROADCAST_BYTES:
        present = present.join(F.broadcast(keys), list(on), "left_semi")
    new = rows_to_insert(present, rows, on).select(*schema.fieldNames())
    day = F.to_date(prune_by) if prune_by else F.lit(None).cast("date")
    filed = new.withColumns({DAY: day, RUN: F.lit(run), BATCH: F.lit(batch).cast("bigint")})
    writer = filed.write.partitionBy(DAY, RUN, BATCH).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(target)


def merge_changes(
    stream: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    target: str,
    schema: T.StructType,
    on: dict[str, str],
    checkpoint: str,
    every: str | None = None,
    prune_by: str | None = None,
) -> StreamingQuery:
    """Enrich every micro-batch and insert its new rows into the target.

    Nothing runs while the stream is empty.
    """

    def handle(batch_rows: DataFrame, batch: int) -> None:
        # the query id lives in the checkpoint: same after a restart, new with a new checkpoint
        run = batch_rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        enriched = enrich(batch_rows).persist()
        try:
            insert_batch(enriched, target, schema, on, run, batch, prune_by)
        finally:
            enriched.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return start(writer, every)


def run_chain(*steps: Callable[[], StreamingQuery]) -> None:
    """Run steps one after the other, each over what the former left behind."""
    for step in steps:
        step().awaitTermination()


def catch_up(
    rows: DataFrame,
    target: str,
    schema: T.StructType,
    on: dict[str, str],
    label: str,
    prune_by: str | None = None,
) -> None:
    """Insert whatever the stream missed, by comparing the rows with the target.

    ``label`` names this catch-up, such as its date; repeating it replaces it.
    ``prune_by`` as in :func:`insert_batch`; without it the whole target is read.
    """
    insert_batch(rows, target, schema, on, f"catchup-{label}", 0, prune_by)
