from __future__ import annotations

import random

from pyspark.sql import functions as F

from lakeworks.functions.network import ip_to_int
from lakeworks.operators import joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_range_join_equals_brute_force(spark):
    rng = random.Random(5)
    top = 2**32 - 1
    points = [0, top, 65535, 65536] + [rng.randrange(2**32) for _ in range(200)] + [100_000] * 300
    ranges = [(0, 0), (top, top), (65535, 65536), (0, top), (10, 5), (99_000, 101_000), (99_999, 100_001)]
    for _ in range(100):
        low = rng.randrange(2**32)
        ranges.append((low, min(top, low + rng.choice([0, 100, 70_000, 10**7]))))
    p = spark.createDataFrame([(i, v) for i, v in enumerate(points)] + [(-1, None)], "id int, v bigint")
    r = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ranges)], "rid int, lo bigint, hi bigint")
    got = joins.range_join(p, r, F.col("v"), "lo", "hi")
    want = sorted((i, j) for i, v in enumerate(points) for j, (a, b) in enumerate(ranges) if a <= v <= b)
    assert pairs(got, "id", "rid") == want
    assert "NestedLoop" not in plan(got)
    coarse = joins.range_join(p, r, F.col("v"), "lo", "hi", bits=24, keep_bucket=True)
    assert pairs(coarse, "id", "rid") == want


def test_keyed_and_plain_ip_join_agree(spark):
    logs = spark.createDataFrame(
        [("1", "10.3.200.7"), ("2", "10.4.0.1"), ("3", "10.4.99.255"), ("4", "10.4.100.0"), ("5", "bad"), ("6", None)],
        "id string, ip_address string",
    )
    loc = spark.createDataFrame([("10.3.200.0", "10.4.99.255", "x")], "a string, b string, city string").select(
        "city", ip_to_int("a").alias("start_ip_int"), ip_to_int("b").alias("end_ip_int")
    )
    keyed = joins.with_join_keys(loc)
    assert keyed.count() == 2
    want = [("1", "x"), ("2", "x"), ("3", "x")]
    assert pairs(joins.keyed_ip_join(logs, keyed), "id", "city") == want
    assert pairs(joins.ip_range_join(logs, loc), "id", "city") == want


def test_every_combination_equals_product(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a int")
    right = spark.createDataFrame([("x",), ("y",), (None,)], "b string")
    got = joins.every_combination(left, right, spread=5)
    key = lambda t: (str(t[0]), str(t[1]))
    want = sorted([(a, b) for a in (1, 2, 2, None) for b in ("x", "y", None)], key=key)
    assert sorted([tuple(r) for r in got.collect()], key=key) == want
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert joins.every_combination(left, right.limit(0)).count() == 0


def test_wide_text_counts_with_its_real_size(spark):
    wide = spark.range(100).select(F.col("id").alias("k"), F.expr("repeat('x', 2000)").alias("t"))
    assert joins.measured_bytes(wide) > 200_000
    nested = wide.select("k", F.array(F.struct("t")).alias("a"))
    assert joins.measured_bytes(nested) > 200_000
    assert joins.measured_bytes(wide.limit(0)) == 0


def test_lookup_is_broadcast_only_when_it_fits(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("n", F.col("k") * 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # Spark's estimate never suffices
        measured = joins.lookup_join(facts, small, "k")
        assert "BroadcastHashJoin" in plan(measured)
        too_big = joins.lookup_join(facts, small, "k", max_bytes=64)
        assert "SortMergeJoin" in plan(too_big)
        assert pairs(measured, "id", "n") == pairs(too_big, "id", "n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_exploding_lookup_is_counted_not_estimated(spark):
    wide = spark.range(1).select(F.lit(0).cast("bigint").alias("lo"), F.lit(2**32 - 1).alias("hi"))
    buckets = joins.with_range_buckets(wide, "lo", "hi", "b")
    points = spark.range(10).withColumnRenamed("id", "b")
    assert "BroadcastHashJoin" in plan(points.join(joins.sized_lookup(buckets), "b"))
    assert "SortMergeJoin" in plan(points.join(joins.sized_lookup(buckets, max_bytes=1 << 20), "b"))


def test_hot_key_is_split_when_the_lookup_is_too_big(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",  # only 8 partitions here
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        facts = spark.range(0, 60_000, 1, 8).withColumn("k", hot).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
        lookup = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
        joined = joins.lookup_join(facts, lookup, "k", max_bytes=64)
        assert joined.agg(F.count("*"), F.sum("n")).first()[0] == 60_000
        result = joined.agg(F.sum(F.length("pad")))
        result.collect()
        assert "skew=true" in plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_restrict_to_keys_does_not_multiply(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert joins.restrict_to_keys(facts, keys, "k").count() == 2


def test_cover_join_equals_brute_force(spark):
    rng = random.Random(9)
    ranges = [(a, a + rng.choice([0, 1, 5, 255, 256, 70_000, 2**24, 2**31])) for a in (rng.randrange(2**32) for _ in range(60))]
    ranges += [(0, 2**32 - 1), (0, 0), (2**32 - 1, 2**32 - 1), (5, 4), (2**61, 2**62), (None, 3), (-4, 9)]
    points = [rng.randrange(2**32) for _ in range(150)] + [0, 2**32 - 1, 2**61, 2**62, None, -1]
    points += [b + d for a, b in ranges[:30] for d in (0, 1)]
    p = spark.createDataFrame(list(enumerate(points)), "id bigint, v bigint")
    r = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ranges)], "rid bigint, lo bigint, hi bigint")
    want = sorted(
        (i, j) for i, v in enumerate(points) for j, (a, b) in enumerate(ranges) if None not in (v, a, b) and 0 <= a <= v <= b
    )
    for step in (1, 4, 7):
        got = joins.cover_join(p, r, F.col("v"), "lo", "hi", step)
        assert pairs(got, "id", "rid") == want
        assert "NestedLoop" not in plan(got)
        blocks = joins.with_cover(r, "lo", "hi", "level", "block", step)
        sizes = blocks.groupBy("rid", "lo", "hi").agg(F.sum(F.expr("shiftleft(1L, level)")).alias("n"))
        assert sizes.filter("n <> hi - lo + 1").count() == 0
        assert blocks.groupBy("rid", "level").count().agg(F.max("count")).first()[0] <= 2 * (2**step - 1)
    assert joins.cover_join(p, r.limit(0), F.col("v"), "lo", "hi").count() == 0
