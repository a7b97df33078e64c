from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeworks import session
from lakeworks.operators import storage, tables
from lakeworks.plans import orders
from lakeworks.schemas import struct
from lakeworks.session import cut_lineage, scratch_path, shared_folder


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_conform_matches_names_in_any_case(spark):
    got = tables.conform(
        frame(spark, [("7", "x", True)], "B string, a string, extra boolean"),
        struct(A="string", b="int", missing="double"),
    )
    assert got.columns == ["A", "b", "missing"] and rows(got) == [("x", 7, None)]
    twice = spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("X"))
    with pytest.raises(ValueError, match="only in case"):
        tables.conform(twice, struct(x="int"))


def test_update_and_delete_leave_null_conditions_alone(spark):
    df = frame(spark, [(1, "a"), (2, None), (3, "b")], "id int, v string")
    assert rows(tables.update_where(df, F.col("v") == "a", v=F.lit("z"))) == [(1, "z"), (2, None), (3, "b")]
    assert rows(tables.delete_where(df, F.col("v") == "a")) == [(2, None), (3, "b")]
    assert rows(tables.delete_where(df, F.col("v").like("%b%"))) == [(1, "a"), (2, None)]


def test_update_from_never_multiplies_and_keeps_unmatched(spark):
    target = frame(spark, [("k1", "old", "m"), ("k1", "old2", "m"), ("k2", "old", "m"), (None, "old", "m")], "k string, v string, m string")
    source = frame(spark, [("k1", "b"), ("k1", "a"), (None, "n"), ("k9", "x")], "k string, v string")
    got = tables.update_from(target, source, ["k"], ["v"])
    assert rows(got) == rows(frame(spark, [("k1", "a", "m"), ("k1", "a", "m"), ("k2", "old", "m"), (None, "old", "m")], "k string, v string, m string"))
    emptied = tables.update_from(target, frame(spark, [("k2", None)], "k string, v string"), ["k"], ["v"])
    assert ("k2", None, "m") in rows(emptied)


KEY = {"g": "g", "at": "at"}


def test_merge_insert(spark):
    target = frame(spark, [("a", 1, "t"), (None, 2, "t")], "g string, at int, v string")
    source = frame(spark, [("a", 1, "s"), ("b", 1, "s"), ("b", 1, "s"), (None, 2, "s")], "g string, at int, v string")
    once = tables.merge_insert(target, source, KEY)
    assert rows(once) == rows(
        frame(spark, [("a", 1, "t"), (None, 2, "t"), ("b", 1, "s"), ("b", 1, "s"), (None, 2, "s")], "g string, at int, v string")
    )
    keyed = source.filter("g is not null")
    again = tables.merge_insert(tables.merge_insert(target, keyed, KEY), keyed, KEY)
    assert rows(again) == rows(tables.merge_insert(target, keyed, KEY))


def test_merge_update(spark):
    target = frame(spark, [("a", 1, "t"), ("a", 2, "t"), (None, 1, "t")], "g string, at int, v string")
    source = frame(spark, [("a", 1), ("a", 1), (None, 1)], "user string, ts int")
    got = tables.merge_update(target, source, {"g": "user", "at": "ts"}, v=F.lit("new"))
    assert rows(got) == rows(frame(spark, [("a", 1, "new"), ("a", 2, "t"), (None, 1, "t")], "g string, at int, v string"))


def test_schema_changes(spark):
    df = frame(spark, [(1, "x")], "id int, name string")
    assert rows(tables.add_column(df, "filled", "boolean", False)) == [(1, "x", False)]
    assert tables.rename_column(df, "name", "fruit_name").columns == ["id", "fruit_name"]
    assert tables.drop_column(df, "name").columns == ["id"]
    for change in (lambda: tables.drop_column(df, "gone"), lambda: tables.rename_column(df, "gone", "x")):
        with pytest.raises(ValueError, match="gone"):
            change()
    assert tables.empty_like(df).columns == df.columns and tables.empty_like(df).count() == 0


def test_append_aligns_by_name(spark):
    target = frame(spark, [(1, "x")], "id int, name string")
    more = frame(spark, [("y", 2)], "name string, id int")
    assert rows(tables.append(target, more)) == [(1, "x"), (2, "y")]
    assert rows(tables.append(target, more.drop("id"))) == [(1, "x"), (None, "y")]


def test_row_keys(spark):
    df = cut_lineage(spark.range(0, 5000, 1, 7).filter("id % 3 > 0").repartition(5, "id"))
    numbers = [r["n"] for r in tables.number_rows(df, "n", start=10).collect()]
    assert sorted(numbers) == list(range(10, 10 + df.count()))
    keys = [r["k"] for r in tables.with_sequence(df, "k", start=5).collect()]
    assert len(set(keys)) == len(keys) and min(keys) == 5


def test_scratch_is_cleared_on_request(spark):
    kept = cut_lineage(spark.range(10))
    assert kept.count() == 10
    path = kept.inputFiles()[0]
    assert session.clear_scratch(spark) >= 1
    assert not Path(path.removeprefix("file:")).exists()
    assert session.clear_scratch(spark) == 0


def test_orders_and_fruits(spark):
    schema = struct(order_uid="bigint", order_filled="boolean", name_on_order="string", ingredients="string", order_ts="timestamp")
    empty = spark.createDataFrame([], schema)
    first = orders.new_order(empty, ["Figs", "Lime"], "O'Hara'); drop", 1)
    row = first.first()
    assert (row["ingredients"], row["name_on_order"], row["order_filled"]) == ("Figs Lime ", "O'Hara'); drop", False)
    assert row["order_ts"] is not None
    both = orders.new_order(first, ["Kiwi"], None, 2)
    assert rows(orders.fill_anonymous(both), "order_uid", "order_filled") == [(1, False), (2, True)]
    fruits = frame(spark, [(1, "Figs"), (2, "Lime")], "fruit_id int, fruit_name string")
    assert rows(orders.with_search_names(fruits, {"Figs": "Fig"})) == [(1, "Figs", "Fig"), (2, "Lime", "Lime")]


def test_versions(spark):
    table = scratch_path(spark, "t")
    with pytest.raises(FileNotFoundError):
        storage.read(spark, table)
    assert storage.publish(spark.range(3), table) == 1
    current = storage.read(spark, table)
    assert storage.publish(current.filter("id > 0"), table) == 2  # derived from the version being read
    assert rows(storage.read(spark, table)) == [(1,), (2,)] and storage.read(spark, table, 1).count() == 3
    # an attempt that died leaves no success marker and is not read, then replaced
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table}/version=3")
    assert storage.read(spark, table).count() == 2
    assert storage.truncate(spark, table) == 3
    assert storage.read(spark, table).count() == 0 and storage.read(spark, table).columns == ["id"]
    assert storage.create_as(spark.range(500), scratch_path(spark, "top"), rows=100).count() == 100


def test_snapshot_is_independent(spark):
    path = scratch_path(spark, "plain")
    storage.append_files(spark.range(2), path)
    copy = storage.snapshot(spark.read.parquet(path), scratch_path(spark, "copy"))
    storage.append_files(spark.range(5), path)
    assert copy.count() == 2 and spark.read.parquet(path).count() == 7


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
