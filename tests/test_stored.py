"""Sequences, change feeds, stored projections and text in chunks."""

from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import aggregates, projections, sequences, storage
from lakeworks.sources import files


def test_loads_never_share_a_key(spark, tmp_path):
    folder = str(tmp_path / "seq")
    loads = [sequences.with_claimed_keys(spark.range(n), folder, "key", block=100) for n in (250, 0, 100, 1)]
    keys = [sorted(r["key"] for r in load.collect()) for load in loads]
    assert [len(k) for k in keys] == [250, 0, 100, 1] and len(set(sum(keys, []))) == 351
    assert keys[0] == list(range(1, 251)) and keys[2] == list(range(301, 401))
    # used twice, a load keeps its keys
    assert sorted(r["key"] for r in loads[0].collect()) == keys[0]


def test_a_failed_load_leaves_a_gap(spark, tmp_path):
    folder = str(tmp_path / "seq")
    assert sequences.claim(spark, folder, 5, block=10) == [0]  # and then nothing is loaded
    again = sequences.with_claimed_keys(spark.range(3), folder, "key", block=10)
    assert sorted(r["key"] for r in again.collect()) == [11, 12, 13]


def test_writers_at_the_same_time(spark, tmp_path):
    folder = str(tmp_path / "seq")
    found = []
    writers = [threading.Thread(target=lambda: found.extend(sequences.claim(spark, folder, 7, block=2))) for _ in range(2)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(found) == 8 and len(set(found)) >= 7
    assert len(sequences.claimed_blocks(spark, folder)) >= 7


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("k", "v", "change", "n_rows").collect())


def test_changes_between_contents(spark):
    kind = "k string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("c", 1), ("d", None), ("", 5), ("e", 2), ("e", 3)], kind)
    new = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None), ("", 5), ("e", 3), ("e", 2), ("f", 9), ("f", 9)], kind)
    want = [("b", 1, "update_before", 1), ("c", 1, "update_before", 1), ("c", 2, "update_after", 1), ("f", 9, "inserted", 2)]
    assert rows_of(storage.changes_between(old, new, ["k"])) == want
    back = storage.changes_between(new.select("v", "k"), old, ["k"])
    assert ("f", 9, "deleted", 2) in rows_of(back) and ("b", 1, "update_after", 1) in rows_of(back)
    twins = [spark.createDataFrame([("a", n), ("a", n)], kind) for n in (1, 2)]
    assert rows_of(storage.changes_between(*twins, ["k"])) == [("a", 1, "update_before", 2), ("a", 2, "update_after", 2)]
    nulls = spark.createDataFrame([(None, 1)], kind)
    assert [tuple(r) for r in storage.changes_between(nulls, nulls.withColumn("v", F.lit(2)), ["k"]).orderBy("v").collect()] == [
        (None, 1, "update_before", 1),
        (None, 2, "update_after", 1),
    ]
    with pytest.raises(ValueError):
        storage.changes_between(old, new.withColumnRenamed("v", "w"), ["k"])


def test_reader_resumes_from_a_version(spark, tmp_path):
    table, seen = str(tmp_path / "t"), str(tmp_path / "seen")
    contents = [[("a", 1)], [("a", 1), ("b", 2)], [("b", 3)]]
    with pytest.raises(FileNotFoundError):
        storage.pending_changes(spark, table, seen, ["k"])
    for content in contents[:2]:
        storage.publish(spark.createDataFrame(content, "k string, v int"), table)
    found, version = storage.pending_changes(spark, table, seen, ["k"])
    assert rows_of(found) == [("a", 1, "inserted", 1), ("b", 2, "inserted", 1)] and version == 2
    # not confirmed: the same again
    assert rows_of(storage.pending_changes(spark, table, seen, ["k"])[0]) == rows_of(found)
    storage.confirm(spark, seen, version)
    assert rows_of(storage.pending_changes(spark, table, seen, ["k"])[0]) == []
    storage.publish(spark.createDataFrame(contents[2], "k string, v int"), table)
    found, version = storage.pending_changes(spark, table, seen, ["k"])
    assert rows_of(found) == [("a", 1, "deleted", 1), ("b", 2, "update_before", 1), ("b", 3, "update_after", 1)]
    assert storage.consumed(spark, seen) == 2 and version == 3


def test_refresh_computes_only_changed_files(spark, tmp_path):
    source, stored = tmp_path / "in", str(tmp_path / "stored")
    source.mkdir()
    for name, text in {"a": "1\n2", "b": "3", "c d": "4"}.items():
        (source / f"{name}.txt").write_text(text)
    asked = []

    def compute(paths):
        asked.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_url"), "value")

    def bring_up_to_date():
        done = projections.refresh(files.list_files(spark, str(source)), stored, compute)
        return done, sorted(r["value"] for r in projections.read(spark, stored).collect())

    with pytest.raises(FileNotFoundError):
        projections.read(spark, stored)
    assert bring_up_to_date() == ({"computed": 3, "kept": 0, "removed": 0}, ["1", "2", "3", "4"])
    assert bring_up_to_date() == ({"computed": 0, "kept": 3, "removed": 0}, ["1", "2", "3", "4"])
    (source / "b.txt").write_text("30")
    (source / "e.txt").write_text("5")
    (source / "a.txt").unlink()
    assert bring_up_to_date() == ({"computed": 2, "kept": 1, "removed": 1}, ["30", "4", "5"])
    assert asked[1:] == [["b.txt", "e.txt"]]
    (source / "e.txt").unlink()
    assert bring_up_to_date() == ({"computed": 0, "kept": 2, "removed": 1}, ["30", "4"])


@pytest.mark.parametrize("group_rows", [20, 10**6])
def test_chunks_make_the_whole_text(spark, group_rows):
    rng = random.Random(4)
    rows = [("a", n, "x" * rng.randrange(9)) for n in range(200)] + [("a", 50, f"tie {n}") for n in range(5)]
    rows += [("b", 1, "é"), ("b", 2, None), ("c", 1, None), (None, 3, "p"), (None, 4, ""), ("d", 1, "y" * 300), ("d", 2, "z")]
    df = spark.createDataFrame(rows, "g string, k int, v string")
    found = aggregates.text_chunks(df, ["g"], F.col("v"), ", ", F.col("k"), F.col("k"), 40, group_rows).collect()
    whole = {r["g"]: r["t"] for r in aggregates.ordered_text(df, ["g"], F.col("v"), ", ", "t", order=F.col("k")).collect()}
    sizes = {r["g"]: (r["n_values"], r["n_chars"]) for r in aggregates.text_sizes(df, ["g"], F.col("v"), ", ").collect()}
    for g, text in whole.items():
        chunks = sorted((r["chunk"], r["start"], r["text"]) for r in found if r["g"] == g)
        made = ""
        for chunk, start, part in chunks:
            assert start == len(made) and chunk == start // 40
            made += part
        assert made == text and sizes[g][1] == len(text)
    assert sizes["c"] == (0, 0) and max(len(r["text"]) for r in found if r["g"] == "a") < 60
