"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on.  Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites in error messages cost several driver round trips per expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` adds or overrides single settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: driver and executors are
    then one process, so a temporary folder is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="lakeworks-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Scratch paths this process has handed out and not cleared.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never handed out twice."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove what was written below the scratch paths handed out so far; the number removed.

    Call it once the results built on them have been written or collected, for
    DataFrames that still read them fail afterwards.
    """
    return sum(remove_scratch(spark, path) for path in list(_SCRATCH))


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Remove one scratch path that nothing reads any more; other paths are refused."""
    _SCRATCH.remove(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles removed that no plan refers to any more.

    Spark's cleaner notices them when the driver's memory is collected, which may
    take long where the driver does little; between the steps of a long job their
    space is wanted sooner.
    """
    spark.range(1).count()  # the session still holds the plan it ran last
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where a result is scanned several times or must not be recomputed
    differently after an executor is lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def filed_by(df: DataFrame, key: str, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once as a table bucketed by ``key``, so that joins on the key do not shuffle its rows again.

    ``df`` should be dealt by the key already, as every task writes a file for each
    bucket it holds.  What reads the table must be written or collected within the
    context: at its end the catalog forgets the table, while its files stay like
    those of :func:`cut_lineage`.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = f"{label}_{path.rpartition('-')[2]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
