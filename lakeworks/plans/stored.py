"""Queries over stored state: sequences, versions, projections, external tables, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions import sql_functions, temporal
from lakeworks.operators import aggregates, projections, sequences, storage
from lakeworks.plans.standins import Tables
from lakeworks.schemas import struct
from lakeworks.session import scratch_path
from lakeworks.sources import documents, files, tables
from lakeworks.streaming import compaction, pipeline

#: Length of a text chunk; far below what a cell may hold, so that a small table has several.
CHUNK_CHARS = 4096


def text_in_chunks(t: Tables) -> DataFrame:
    """Names of each segment's customers as one text, in chunks."""
    found = aggregates.text_chunks(
        t.customer, ["c_mktsegment"], F.col("c_name"), ", ", F.col("c_custkey"), F.col("c_custkey"), CHUNK_CHARS
    )
    return found.withColumn("chunk", F.col("chunk").cast("bigint"))


def text_sizes(t: Tables) -> DataFrame:
    """Length of that text, which is never made."""
    return aggregates.text_sizes(t.customer, ["c_mktsegment"], F.col("c_name"), ", ")


def claimed_keys(t: Tables) -> DataFrame:
    """Two loads that take their keys from one stored sequence."""
    sequence = scratch_path(t.spark, "sequence")
    loads = [t.orders.filter(F.col("o_orderkey") % 2 == k).select("o_orderkey") for k in (0, 1)]
    keyed = [sequences.with_claimed_keys(load, sequence, "key").withColumn("load", F.lit(k)) for k, load in enumerate(loads)]
    both = keyed[0].unionByName(keyed[1])
    return both.groupBy("load").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("key").alias("n_keys"),
        (F.min("key") % sequences.BLOCK).alias("first_in_block"),
    )


def version_changes(t: Tables) -> DataFrame:
    """What a reader of changes finds between the version it confirmed and the newest one."""
    table, seen = scratch_path(t.spark, "versions"), scratch_path(t.spark, "seen")
    first = t.orders.select("o_orderkey", "o_orderstatus")
    storage.confirm(t.spark, seen, storage.publish(first, table))
    key = F.col("o_orderkey")
    kept = first.filter(key % 10 != 3).withColumn("o_orderstatus", F.when(key % 10 == 5, "X").otherwise(F.col("o_orderstatus")))
    storage.publish(kept.unionByName(first.filter(key % 10 == 7).withColumn("o_orderkey", -key)), table)
    return storage.pending_changes(t.spark, table, seen, ["o_orderkey"])[0]


def refreshed_projection(t: Tables) -> DataFrame:
    """A projection over Parquet files, refreshed after one file came and one went; totals by segment."""
    source, stored = scratch_path(t.spark, "source"), scratch_path(t.spark, "projection")
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    for k in range(3):
        rows.filter(F.col("c_custkey") % 3 == k).write.parquet(f"{source}/third={k}")

    def compute(paths: list[str]) -> DataFrame:
        read = t.spark.read.schema(rows.schema).parquet(*paths)
        return read.select(F.col("_metadata.file_path").alias("file_url"), "c_mktsegment", "c_custkey")

    def refresh() -> dict[str, int]:
        return projections.refresh(files.list_files(t.spark, source, "part-*"), stored, compute)

    refresh()
    rows.withColumn("c_custkey", -F.col("c_custkey")).write.parquet(f"{source}/negative")
    rows.limit(0).write.mode("overwrite").parquet(f"{source}/third=1")
    refresh()
    return projections.read(t.spark, stored).groupBy("c_mktsegment").agg(
        F.count("*").alias("n_rows"), F.sum("c_custkey").alias("sum_key")
    )


def external_table(t: Tables) -> DataFrame:
    """A catalog table over Parquet files that stay where they are; the folder's name holds a quote."""
    path = scratch_path(t.spark, "it's external")
    t.supplier.select("s_suppkey", "s_nationkey").write.parquet(path)
    table = tables.external_table(t.spark, f"external_{path.rsplit('-', 1)[1]}", path)
    named = F.col(tables.FILE_NAME).endswith(".parquet")
    return table.groupBy("s_nationkey").agg(F.count("*").alias("n_rows"), F.sum(named.cast("bigint")).alias("n_named"))


def json_documents(t: Tables) -> DataFrame:
    """One JSON document per region with its nations nested, written over several lines."""
    nation = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"))
    regions = t.nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(nation)).alias("nations"))
    text = F.to_json(F.struct(F.struct(F.col("n_regionkey").alias("key")).alias("region"), "nations"), {"pretty": "true"})
    path = scratch_path(t.spark, "documents")
    regions.select(text.alias("value"), "n_regionkey").write.partitionBy("n_regionkey").text(path)
    whole = documents.read_json_document(t.spark, f"{path}/*")
    each = whole.select(
        F.variant_get("whole_object", "$.region.key", "bigint").alias("region"),
        F.explode(F.variant_get("whole_object", "$.nations", "array<variant>")).alias("nation"),
    )
    return each.select(
        "region", F.variant_get("nation", "$.name", "string").alias("name"), F.variant_get("nation", "$.key", "bigint").alias("key")
    )


def parameter_sum(t: Tables) -> DataFrame:
    """Sum of three session variables, the counts of three tables."""
    counts = {f"n_{name}": getattr(t, name).count() for name in ("nation", "region", "supplier")}
    return t.region.agg(F.count("*").alias("n")).select(F.lit(sql_functions.variables_sum(t.spark, **counts)).cast("bigint").alias("total"))


def load_times(t: Tables) -> DataFrame:
    """Rows by load second: all of one load have the same, without a fraction."""
    loaded = t.orders.select("o_orderstatus", temporal.load_second().alias("at"))
    return loaded.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("at").alias("n_times"),
        F.max(F.date_format("at", "SSSSSS")).alias("fraction"),
        F.min(F.col("at") <= F.current_timestamp()).alias("in_past"),
    )


def _log_files(t: Tables, base: str) -> None:
    fields = F.struct(
        F.lit("10.0.0.1").alias("ip_address"),
        F.col("user_id").cast("string").alias("user_login"),
        F.col("event_type").alias("user_event"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime_iso8601"),
    )
    t.events.select(F.to_json(fields).alias("value")).write.text(f"{base}/files")


def purged_files(t: Tables) -> DataFrame:
    """Log files read, archived and deleted; one that is not JSON stays.  Rows landed by kind of event."""
    base = scratch_path(t.spark, "purge")
    _log_files(t, base)
    t.region.limit(1).select(F.lit("not [ JSON").alias("value")).write.mode("append").text(f"{base}/files")
    for _ in range(2):  # a file is moved when the batch after it was read
        pipeline.run_chain(
            lambda: pipeline.ingest_files(t.spark, f"{base}/files", f"{base}/landing", f"{base}/checkpoint", purge=True)
        )
    pipeline.purge_archive(t.spark, f"{base}/checkpoint")
    landed = t.spark.read.schema(pipeline.LANDING).parquet(f"{base}/landing")
    left = pipeline.rejects(t.spark, f"{base}/files").select("text")
    if pipeline.exists(t.spark, pipeline.archive_of(f"{base}/checkpoint")):
        left = left.unionByName(pipeline.rejects(t.spark, pipeline.archive_of(f"{base}/checkpoint")).select("text"))
    return landed.groupBy(F.col("user_event").alias("kind")).agg(F.count("*").alias("n_rows")).unionByName(
        left.groupBy(F.regexp_replace("text", r"\s+$", "").alias("kind")).agg(F.count("*").alias("n_rows"))
    )


def compacted_target(t: Tables) -> DataFrame:
    """A merge target filled in many batches, then compacted: its rows by kind, and whether fewer folders are left."""
    base, spark = scratch_path(t.spark, "compacted"), t.spark
    schema = struct(user_event="string", at="timestamp_ntz", event_id="bigint")
    rows = t.events.select(F.col("event_type").alias("user_event"), F.col("ts").cast("timestamp_ntz").alias("at"), "event_id")
    for batch in range(3):
        part = rows.filter(F.col("event_id") % 3 <= batch)
        pipeline.insert_batch(part, base, schema, {"event_id": "event_id", "at": "at"}, "run", batch, prune_by="at")
    before = compaction.folders(spark, base).count()
    compaction.compact(spark, base, schema)
    pipeline.insert_batch(rows, base, schema, {"event_id": "event_id", "at": "at"}, "run", 3, prune_by="at")
    after = compaction.folders(spark, base).count()
    return pipeline.read_target(spark, base, schema).groupBy("user_event").agg(F.count("*").alias("n_rows"), F.lit(after < before).alias("fewer_folders"))


def periodic_ingest(t: Tables) -> DataFrame:
    """Log files that come in two parts, picked up by one stream on a schedule; its empty intervals run nothing."""
    base = scratch_path(t.spark, "periodic")
    _log_files(t, base)
    query = pipeline.ingest_files(t.spark, f"{base}/files", f"{base}/landing", f"{base}/checkpoint", every="200 milliseconds")
    try:
        query.processAllAvailable()
        _log_files_again(t, base)
        query.processAllAvailable()
    finally:
        query.stop()
    batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    landed = t.spark.read.schema(pipeline.LANDING).parquet(f"{base}/landing")
    return landed.groupBy("user_event").agg(
        F.count("*").alias("n_rows"), (F.lit(max(batches) + 1) >= F.lit(2)).alias("in_several_batches")
    )


def _log_files_again(t: Tables, base: str) -> None:
    fields = F.struct(F.col("user_id").cast("string").alias("user_login"), F.lit("late").alias("user_event"))
    t.events.select(F.to_json(fields).alias("value")).write.mode("append").text(f"{base}/files")


QUERIES = {
    "text_in_chunks": text_in_chunks,
    "text_sizes": text_sizes,
    "claimed_keys": claimed_keys,
    "version_changes": version_changes,
    "refreshed_projection": refreshed_projection,
    "external_table": external_table,
    "json_documents": json_documents,
    "parameter_sum": parameter_sum,
    "load_times": load_times,
    "purged_files": purged_files,
    "compacted_target": compacted_target,
    "periodic_ingest": periodic_ingest,
}

_PIECES = """
pieces AS (
  SELECT c_mktsegment, n, len_before + greatest(n - 1, 0) * 2 AS start, CASE WHEN n = 0 THEN c_name ELSE ', ' || c_name END AS piece
  FROM (
    SELECT c_mktsegment, c_name, row_number() OVER w - 1 AS n, sum(length(c_name)) OVER w - length(c_name) AS len_before
    FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_custkey)
  ))"""

_SIGNED = """
changed AS (
  SELECT o_orderkey, o_orderstatus, 'deleted' AS change FROM orders WHERE o_orderkey % 10 = 3
  UNION ALL SELECT o_orderkey, o_orderstatus, 'update_before' FROM orders WHERE o_orderkey % 10 = 5 AND o_orderstatus <> 'X'
  UNION ALL SELECT o_orderkey, 'X', 'update_after' FROM orders WHERE o_orderkey % 10 = 5 AND o_orderstatus <> 'X'
  UNION ALL SELECT -o_orderkey, o_orderstatus, 'inserted' FROM orders WHERE o_orderkey % 10 = 7)"""

ORACLES = {
    "text_in_chunks":
        f"WITH {_PIECES} SELECT c_mktsegment, CAST(start // {CHUNK_CHARS} AS BIGINT) AS chunk, CAST(min(start) AS BIGINT) AS start, "
        "string_agg(piece, '' ORDER BY n) AS text FROM pieces GROUP BY ALL",
    "text_sizes":
        "SELECT c_mktsegment, count(c_name) AS n_values, CAST(length(string_agg(c_name, ', ')) AS BIGINT) AS n_chars "
        "FROM customer GROUP BY c_mktsegment",
    "claimed_keys":
        "SELECT CAST(o_orderkey % 2 AS INT) AS load, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, "
        "CAST(1 AS BIGINT) AS first_in_block FROM orders GROUP BY load",
    "version_changes": f"WITH {_SIGNED} SELECT *, CAST(1 AS BIGINT) AS n_rows FROM changed",
    "refreshed_projection":
        "SELECT c_mktsegment, count(*) AS n_rows, CAST(sum(key) AS BIGINT) AS sum_key FROM ("
        "SELECT c_mktsegment, c_custkey AS key FROM customer WHERE c_custkey % 3 <> 1 "
        "UNION ALL SELECT c_mktsegment, -c_custkey FROM customer) GROUP BY c_mktsegment",
    "external_table": "SELECT s_nationkey, count(*) AS n_rows, count(*) AS n_named FROM supplier GROUP BY s_nationkey",
    "json_documents":
        "SELECT CAST(n_regionkey AS BIGINT) AS region, n_name AS name, CAST(n_nationkey AS BIGINT) AS key FROM nation",
    "parameter_sum":
        "SELECT (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + (SELECT count(*) FROM supplier) AS total",
    "load_times":
        "SELECT o_orderstatus, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_times, '000000' AS fraction, true AS in_past "
        "FROM orders GROUP BY o_orderstatus",
    "purged_files":
        "SELECT event_type AS kind, count(*) AS n_rows FROM events GROUP BY event_type UNION ALL SELECT 'not [ JSON', 1",
    "compacted_target": "SELECT event_type AS user_event, count(*) AS n_rows, true AS fewer_folders FROM events GROUP BY event_type",
    "periodic_ingest":
        "SELECT event_type AS user_event, count(*) AS n_rows, true AS in_several_batches FROM events GROUP BY event_type "
        "UNION ALL SELECT 'late', count(*), true FROM events",
}
