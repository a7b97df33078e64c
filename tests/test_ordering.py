from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from lakeworks.functions.temporal import second_index
from lakeworks.operators import aggregates, sessions
from lakeworks.operators.ordering import large_groups, with_next, with_slices


def brute_next(rows):
    out = []
    for g in {r[0] for r in rows}:
        mine = sorted(r[1:] for r in rows if r[0] == g)
        out += [(g, *a, *(b or (None, None))) for a, b in zip(mine, [*mine[1:], None])]
    return sorted(out, key=str)


def test_next_row_in_cut_and_uncut_groups(spark):
    rng = random.Random(3)
    rows = [("hot", n, n * 10) for n in rng.sample(range(100_000), 700)]
    rows += [("hot", 2_000_000 + n, 1) for n in range(40)]  # far from the rest: empty slices between
    rows += [(f"g{n % 7}", n, n) for n in range(60)] + [(None, n, n) for n in range(150)]
    rows += [("single", 1, 1)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    for limit in (10, 100, 10_000):
        got = with_next(df, ["g"], "o", {"no": "o", "nv": "v"}, F.col("o"), group_rows=limit)
        assert sorted([tuple(r) for r in got.collect()], key=str) == brute_next(rows)
    assert large_groups(df, ["g"], F.col("o"), 100).count() == 2


def test_group_with_one_position_is_left_whole(spark):
    df = spark.createDataFrame([("g", 5, n) for n in range(50)], "g string, o bigint, v bigint")
    got = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"), group_rows=10)
    assert got.filter("no is null").count() == 1 and got.count() == 50


def test_missing_order_values_come_first_at_any_size(spark):
    rows = [("g", None, n) for n in range(3)] + [("g", n, n) for n in range(40)]
    rows += [("g", 1000 + n // 30, n) for n in range(60)]  # bursts of equal values
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    found = [
        sorted(((r["o"], r["no"]) for r in with_next(df, ["g"], "o", {"no": "o"}, F.col("o"), limit).collect()), key=str)
        for limit in (5, 20, 1000)
    ]
    assert found[0] == found[1] == found[2]
    assert (None, 0) in found[0] and found[0].count((None, None)) == 2


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 8) + dt.timedelta(minutes=minute, seconds=second)


def test_session_buckets_at_their_bounds(spark):
    gaps = [9, 10, 19, 20, 29, 30, 39, 40, 41]
    rows, minute = [], 0
    for gap in gaps:
        rows.append(("a", at(minute), "t"))
        minute += gap
    rows += [("a", at(minute), "t"), ("b", at(0), "t")]
    df = spark.createDataFrame(rows, "gamer_name string, game_event_ltz timestamp_ntz, tod_name string")
    lengths = [r["game_session_length"] for r in sessions.session_lengths(df).collect()]
    assert lengths == sorted([*gaps, 0, 0], reverse=True)
    grid = {r["session_length"]: r["n_sessions"] for r in sessions.session_grid(df).collect()}
    assert grid == {"< 10 mins": 1, "10 to 19 mins": 2, "20 to 29 mins": 2, "30 to 39 mins": 2, "> 40 mins": 2}
    cut = sessions.session_lengths(df, group_rows=3).collect()
    assert [tuple(r) for r in cut] == [tuple(r) for r in sessions.session_lengths(df).collect()]


def test_slices_follow_time(spark):
    rows = [("a", at(n, n % 60)) for n in range(200)]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz")
    got = with_next(df, ["g"], "ts", {"nx": "ts"}, second_index("ts"), group_rows=7).collect()
    pairs = sorted((r["ts"], r["nx"]) for r in got if r["nx"])
    assert pairs == [(a[1], b[1]) for a, b in zip(rows, rows[1:])]


def test_ordered_text(spark):
    rows = [("a", 10, "x"), ("a", 9, "y"), ("a", 100, None), ("a", 11, "x"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "g string, k int, v string")
    whole = aggregates.ordered_text(df, ["g"], F.col("v"), "|", "t", order=F.col("k"))
    pieces = aggregates.ordered_text(
        df, ["g"], F.col("v"), "|", "t", order=F.col("k"), stretch=F.floor(F.col("k") / 10)
    )
    want = {"a": "y|x|x", "b": ""}
    assert {r["g"]: r["t"] for r in whole.collect()} == want
    assert {r["g"]: r["t"] for r in pieces.collect()} == want
    numbers = aggregates.ordered_text(df, ["g"], F.col("k"), ",", "t")
    assert {r["g"]: r["t"] for r in numbers.collect()}["a"] == "9,10,11,100"


def test_tallies_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "g string, v int")
    counts = aggregates.group_counts(df, ["g"], "n").collect()
    assert [tuple(r) for r in counts] == [("b", 1), ("a", 2)]
    filled = aggregates.filled_per_group(df, ["g"], "v", "n").collect()
    assert {tuple(r) for r in filled} == {("a", 1), ("b", 1)}
    tally = aggregates.row_tallies({"all": (df, F.lit(249)), "none": (df.limit(0), None)}).collect()
    assert {tuple(r) for r in tally} == {("all", 3, 249), ("none", 0, None)}
    assert aggregates.any_match(df, F.col("v") == 2, "t").first()["t"] == 1
    assert aggregates.any_match(df, F.col("v") == 9, "t").first()["t"] == 0
    assert [tuple(r) for r in aggregates.duplicate_keys(df, ["g"]).collect()] == [("a", 2)]


def test_rows_piled_on_one_instant_are_dealt(spark):
    rows = [("g", 7, n) for n in range(900)] + [("g", None, n) for n in range(300)] + [("g", n, 1) for n in (1, 2, 6, 8, 9)]
    rows += [("g", 20 + n // 200, n) for n in range(400)] + [(None, 3, n) for n in range(150)] + [("h", 1, 1)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    plain = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"))
    got = with_next(df, ["g"], "o", {"no": "o", "nv": "v"}, F.col("o"), group_rows=100)
    key = lambda r: str((r["g"], r["o"], r["no"]))
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect()))
    # every row but a group's first is the next of exactly one row
    followed = got.filter("nv IS NOT NULL").groupBy("g", "no", "nv").count()
    assert followed.filter("count > 1").count() == 0 and got.filter("nv IS NULL").count() == 3
    large = large_groups(df, ["g"], F.col("o"), 100, "o")
    sizes = with_slices(df, ["g"], F.col("o"), large, "inner").groupBy("g", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 200


def test_piles_of_different_values_are_not_dealt_by_hash(spark):
    rows = [("g", 2**60 + n // 40, n) for n in range(400)]  # all of one position as a double
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    got = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"), group_rows=50)
    plain = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"))
    assert sorted((r["o"], r["no"] or 0) for r in got.collect()) == sorted((r["o"], r["no"] or 0) for r in plain.collect())


def test_many_cuts_are_met_a_few_at_a_time(spark):
    rows = [("g", n * 7919 % 20_011, n) for n in range(6000)] + [("g", 30_000, n) for n in range(40)]
    rows += [("g", None, n) for n in range(30)] + [("h", n, n) for n in range(9)] + [("n", None, n) for n in range(20)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    large = large_groups(df, ["g"], F.col("o"), 5, "o")
    found = {r["_g_g"]: r for r in large.collect()}
    assert len(found["g"]["_cuts"]) > 32 * 32
    placed = with_slices(df, ["g"], F.col("o"), large, "left")
    for r in placed.collect():
        group, o = found[r["g"]], r["o"]
        piles = {p["pos"] for p in group["_piles"] or []}
        want = 0 if o is None else 1 + sum(c < o for c in group["_cuts"]) + sum((p <= o) + (p < o) for p in piles if p is not None)
        assert r["_slice"] >> 31 == (want if group["_cuts"] else 0)
    # before, every row met all cuts of its group in one join
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 4 and "filter(_cuts" not in plan
    got = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"), group_rows=5)
    plain = with_next(df, ["g"], "o", {"no": "o"}, F.col("o"))
    key = lambda r: str((r["g"], r["o"], r["no"]))
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect()))
