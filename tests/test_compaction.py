"""Compaction of a merge target: same rows, fewer files, whatever is killed."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import storage
from lakeworks.schemas import struct
from lakeworks.streaming import compaction, pipeline

SCHEMA = struct(who="string", at="timestamp_ntz")
ON = {"who": "who", "at": "at"}


@pytest.fixture
def target(spark, tmp_path):
    return str(tmp_path / "target")


def batch(spark, *rows):
    times = [(w, None if d is None else dt.datetime(2024, 1, d, 3)) for w, d in rows]
    return spark.createDataFrame(times, SCHEMA)


def insert(spark, target, rows, number, run="r"):
    pipeline.insert_batch(batch(spark, *rows), target, SCHEMA, ON, run, number, prune_by="at")


def fill(spark, target, n=5):
    for k in range(n):
        insert(spark, target, [(f"a{k}", 1), (f"b{k}", 2 + k % 2), (f"n{k}", None), ("same", 1)], k)


def content(spark, target):
    rows = pipeline.read_target(spark, target, SCHEMA).select("who", "at").collect()
    return sorted((r["who"], str(r["at"])) for r in rows)


def file_count(spark, target):
    return compaction.folders(spark, target).count()


def test_same_rows_in_fewer_folders(spark, target):
    fill(spark, target)
    before, n = content(spark, target), file_count(spark, target)
    assert compaction.compact(spark, target, SCHEMA) > 0
    assert content(spark, target) == before and file_count(spark, target) < n
    assert compaction.compact(spark, target, SCHEMA) == 0
    # later batches meet the compacted rows, and are compacted with them in turn
    for k in range(5, 9):
        insert(spark, target, [("a0", 1), (f"c{k}", 1), ("n0", None)], k)
    later = content(spark, target)
    assert len(later) == len(before) + 4 + 4  # rows without a time are new every time
    for _ in range(3):
        compaction.compact(spark, target, SCHEMA)
        assert content(spark, target) == later
    per_day = compaction.folders(spark, target).groupBy(pipeline.DAY).count()
    assert per_day.agg(F.max("count")).first()[0] <= 2  # one compacted, and the newest batch


def test_newest_batch_and_catch_up_may_be_repeated(spark, target):
    fill(spark, target)
    pipeline.catch_up(batch(spark, ("late", 1), ("a0", 1)), target, SCHEMA, ON, "x", prune_by="at")
    before = content(spark, target)
    compaction.compact(spark, target, SCHEMA)
    insert(spark, target, [("a4", 1), ("b4", 2), ("n4", None), ("same", 1)], 4)
    pipeline.catch_up(batch(spark, ("late", 1), ("a0", 1)), target, SCHEMA, ON, "x", prune_by="at")
    assert content(spark, target) == before


@pytest.mark.parametrize("step", ["publish", "delete"])
def test_killed_compaction(spark, target, monkeypatch, step):
    fill(spark, target)
    before = content(spark, target)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(*((storage, "publish") if step == "publish" else (compaction, "_delete_replaced")), killed)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, target, SCHEMA)
    assert content(spark, target) == before
    insert(spark, target, [("a0", 1), ("new", 3)], 5)
    before = sorted([*before, ("new", "2024-01-03 03:00:00")])
    assert content(spark, target) == before
    compaction.compact(spark, target, SCHEMA)
    assert content(spark, target) == before
    assert compaction.folders(spark, target).filter(F.col(pipeline.RUN) == "r").count() <= 3


def test_large_days_get_several_files(spark, target):
    for k in range(3):
        insert(spark, target, [(f"{k}-{n}", 1) for n in range(300)], k)
    before = content(spark, target)
    size = compaction.folders(spark, target).agg(F.sum("bytes")).first()[0]
    compaction.compact(spark, target, SCHEMA, file_bytes=size // 5)
    assert content(spark, target) == before
    assert len(list(Path(target).glob("_day=2024-01-01/_run=compacted-*/*/part-*"))) >= 2


def test_nothing_to_compact(spark, target):
    assert compaction.compact(spark, target, SCHEMA) == 0
    insert(spark, target, [("a", 1)], 0)
    assert compaction.compact(spark, target, SCHEMA) == 0
