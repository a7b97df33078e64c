"""Tables as folders of Parquet versions: write aside, then read the newest complete one."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators.joins import restrict_to_keys


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def versions(spark: SparkSession, table: str) -> list[int]:
    """Complete versions of a table, oldest first; unfinished ones have no success marker."""
    fs, root = _file_system(spark, table)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name and fs.exists(marker):
            found.append(int(name.group(1)))
    return sorted(found)


def publish(df: DataFrame, table: str) -> int:
    """Write ``df`` as the next version; readers switch over when it is complete.

    The version being read is never touched, so ``df`` may be derived from it.
    One writer per table at a time.
    """
    version = max(versions(df.sparkSession, table), default=0) + 1
    # an unfinished earlier attempt at the same number is replaced
    df.write.mode("overwrite").parquet(f"{table}/version={version}")
    return version


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Newest version of a table, or a given one."""
    known = versions(spark, table)
    if not known:
        raise FileNotFoundError(f"no complete version below {table}")
    chosen = known[-1] if version is None else version
    if chosen not in known:
        raise FileNotFoundError(f"no complete version {chosen} below {table}")
    return spark.read.parquet(f"{table}/version={chosen}")


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Independent copy of the rows as they are now."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_files(df: DataFrame, path: str) -> None:
    """Add rows to a plain folder table (bulk load)."""
    df.write.mode("append").parquet(path)


def create_as(df: DataFrame, table: str, rows: int | None = None) -> DataFrame:
    """Table from a query, optionally its first ``rows`` rows, published as version 1 or next."""
    publish(df if rows is None else df.limit(rows), table)
    return read(df.sparkSession, table)


def truncate(spark: SparkSession, table: str) -> int:
    """New version without rows and with the same columns."""
    return publish(read(spark, table).limit(0), table)


#: What happened to a row between two versions.
INSERTED, DELETED, BEFORE, AFTER = "inserted", "deleted", "update_before", "update_after"


def changes_between(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that two contents of a table do not share, with ``change`` and ``n_rows``.

    A key in one content only gives ``inserted`` or ``deleted`` rows, a key in both
    ``update_before`` and ``update_after`` rows; rows the key has in both are left
    out.  Rows may repeat: ``n_rows`` says how often.  NULL is a key like others.
    First only a checksum per key is compared, so the rows of unchanged keys are
    not shuffled.  Columns must be the same, in any order, and comparable.
    """
    columns = old.columns
    if sorted(columns) != sorted(new.columns):
        raise ValueError("the contents have different columns")
    key = F.struct(*keys)
    rows = [
        side.select(*columns, F.to_json(key, {"ignoreNullFields": "false"}).alias("_key"), F.lit(sign).alias("_sign"))
        for side, sign in ((old, -1), (new, 1))
    ]
    # a sum, not an exclusive or: two equal rows must not cancel out
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    sums = rows[0].unionByName(rows[1]).groupBy("_key").agg(F.sum(row_hash * F.col("_sign")).alias("_sum"), F.sum("_sign").alias("_n"))
    touched = sums.filter((F.col("_sum") != 0) | (F.col("_n") != 0)).select("_key")
    moved = restrict_to_keys(rows[0].unionByName(rows[1]), touched, "_key")
    rests = moved.groupBy("_key", *columns).agg(F.sum("_sign").alias("_n"))
    both = moved.groupBy("_key").agg((F.min("_sign") != F.max("_sign")).alias("_both"))
    gone = F.col("_n") < 0
    change = F.when(F.col("_both"), F.when(gone, BEFORE).otherwise(AFTER)).otherwise(F.when(gone, DELETED).otherwise(INSERTED))
    found = rests.filter("_n <> 0").join(both, "_key")
    return found.select(*columns, change.alias("change"), F.abs("_n").alias("n_rows"))


def consumed(spark: SparkSession, checkpoint: str) -> int:
    """The last version a reader of changes has confirmed; 0 before the first."""
    fs, root = _file_system(spark, checkpoint)
    if not fs.exists(root):
        return 0
    names = (re.fullmatch(r"consumed-(\d+)", s.getPath().getName()) for s in fs.listStatus(root))
    return max((int(n.group(1)) for n in names if n), default=0)


def confirm(spark: SparkSession, checkpoint: str, version: int) -> None:
    """Record that the changes up to ``version`` were used; repeating it changes nothing."""
    fs, path = _file_system(spark, f"{checkpoint}/consumed-{version:020d}")
    fs.create(path, True).close()


def pending_changes(spark: SparkSession, table: str, checkpoint: str, keys: list[str]) -> tuple[DataFrame, int]:
    """Changes of a published table since the version confirmed last, and the version they lead to.

    A reader that fails before :func:`confirm` gets the same changes again.  Without
    a new version the frame is empty; before the first confirmed version every row
    is inserted.  Versions in between are not replayed: a row inserted and deleted
    again does not show.
    """
    known = versions(spark, table)
    if not known:
        raise FileNotFoundError(f"no complete version below {table}")
    done, latest = consumed(spark, checkpoint), known[-1]
    new = read(spark, table, latest)
    if done == latest:
        return changes_between(new.limit(0), new.limit(0), keys), latest
    return changes_between(read(spark, table, done) if done else new.limit(0), new, keys), latest
