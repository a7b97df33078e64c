"""Sequences whose next value is stored, for loads that must never share a key.

A sequence is a folder with one empty file for each block of keys that was claimed;
the file's number is the block's.  A file is created only if it does not exist, so
of two writers that want the same block one gets it and the other takes the next.
A load that fails leaves a gap, as with any sequence, and never a clash.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators.joins import sized_lookup
from lakeworks.operators.storage import _file_system
from lakeworks.operators.tables import number_rows
from lakeworks.session import cut_lineage

#: Keys of a block.  It belongs to the sequence and must not change.
BLOCK = 1_000_000


def claimed_blocks(spark: SparkSession, sequence: str) -> list[int]:
    """Numbers of the blocks taken so far, in order."""
    fs, root = _file_system(spark, sequence)
    if not fs.exists(root):
        return []
    names = (re.fullmatch(r"block-(\d+)", status.getPath().getName()) for status in fs.listStatus(root))
    return sorted(int(n.group(1)) for n in names if n)


def claim(spark: SparkSession, sequence: str, n: int, block: int = BLOCK) -> list[int]:
    """First keys of enough blocks for ``n`` rows, which no other writer has or will get."""
    fs, root = _file_system(spark, sequence)
    fs.mkdirs(root)
    wanted, found = -(-n // block), []
    number = max(claimed_blocks(spark, sequence), default=-1)
    while len(found) < wanted:
        number += 1
        path = spark._jvm.org.apache.hadoop.fs.Path(root, f"block-{number:020d}")
        try:
            fs.create(path, False).close()
        except Py4JJavaError as failed:
            if not fs.exists(path):
                raise failed
            continue  # another writer has it
        found.append(number * block)
    return found


def with_claimed_keys(rows: DataFrame, sequence: str, name: str, start: int = 1, block: int = BLOCK) -> DataFrame:
    """Rows with a key in ``name`` that no other load of this sequence uses.

    The rows are written once, counted, and numbered by the blocks claimed for
    them; the result reads that table and may be used any number of times.  Keys
    are dense within a block; the rest of a load's last block is left unused.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows, "load")
    firsts = claim(spark, sequence, rows.count(), block)
    blocks = spark.createDataFrame(list(enumerate(firsts)), "_block bigint, _first bigint")
    numbered = number_rows(rows, "_number", 0).withColumn("_block", F.expr(f"_number div {block}"))
    key = (F.col("_first") + F.col("_number") % block + start).cast("bigint").alias(name)
    return numbered.join(sized_lookup(blocks), "_block").select(key, *rows.columns)
