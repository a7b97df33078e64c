from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeworks.functions import geo, network, sql_functions, temporal, text, variants


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("address", "number"),
    [
        ("100.41.16.160", 1680412832),
        ("0.0.0.0", 0),
        ("255.255.255.255", 2**32 - 1),
        ("256.1.1.1", None),
        ("1.2.3", None),
        ("1.2.3.4.5", None),
        ("1.2.3.04", None),
        (" 1.2.3.4", None),
        ("1.2.3.+4", None),
        ("0.0.0.-1", None),
        ("1.256.0.0", None),
        ("1.0.256.0", None),
        ("999.1.1.1", None),
        ("1..2.3", None),
        ("1.2.3.4.", None),
        ("a.b.c.d", None),
        ("", None),
        (None, None),
    ],
)
def test_ip_to_int(spark, address, number):
    df = spark.createDataFrame([(address,)], "ip string")
    row = df.select(network.ip_to_int("ip").alias("n"), network.ip_host("ip").alias("h")).first()
    assert row["n"] == number
    assert row["h"] == (address if number is not None else None)


def test_time_of_day_has_24_hours(spark):
    rows = temporal.time_of_day_lookup(spark).collect()
    assert sorted(r["hour"] for r in rows) == list(range(24))
    assert {r["tod_name"] for r in rows if r["hour"] in (21, 22, 23)} == {"Late evening"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes_between_counts_boundaries_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cases = [
            ("2024-01-01 10:00:59", "2024-01-01 10:01:00", 1),
            ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0),
            ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 120),  # clocks change in New York
            ("2024-12-31 23:59:00", "2025-01-01 00:01:00", 2),
            ("2024-01-01 10:05:00", "2024-01-01 10:00:00", -5),
        ]
        for start, end, minutes in cases:
            df = spark.sql(f"SELECT TIMESTAMP_NTZ'{start}' AS a, TIMESTAMP_NTZ'{end}' AS b")
            assert df.select(temporal.minutes_between("a", "b")).first()[0] == minutes
            assert df.select(
                temporal.second_index("b") - temporal.second_index("a") >= F.lit(minutes * 60 - 59)
            ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_local_time_and_load_second(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00' AS ts, 'America/Denver' AS zone")
    local = df.select(temporal.to_local(F.col("ts"), F.col("zone")).alias("x")).first()["x"]
    assert local == dt.datetime(2024, 7, 1, 6)
    assert one(spark, temporal.load_second()).microsecond == 0


def test_json_null_is_present_but_has_no_value(spark):
    docs = ['{"a": null}', '{"a": 1}', '{"b": 2}', "broken", None]
    df = spark.createDataFrame([(d,) for d in docs], "d string").select(variants.parse("d").alias("v"))
    rows = df.select(variants.present("v", "a").alias("p"), variants.path("v", "a").alias("s")).collect()
    assert [r["p"] for r in rows] == [True, True, False, False, False]
    assert [r["s"] for r in rows] == [None, "1", None, None, None]


def test_paths_types_and_odd_keys(spark):
    doc = '{"user":{"id":7},"tags":[{"text":"x"}],"at":"2022-10-15 21:41:00.000","day":"2024-02-03","odd key":"y","n":1.5}'
    df = spark.createDataFrame([(doc,)], "d string").select(variants.parse("d").alias("v"))
    row = df.select(
        variants.path("v", "user.id", "bigint").alias("id"),
        variants.path("v", "tags[0].text").alias("tag"),
        variants.path("v", "tags[3].text").alias("gone"),
        variants.path("v", "at", "timestamp_ntz").alias("at"),
        variants.path("v", "day", "date").alias("day"),
        variants.path("v", "at", "bigint").alias("unfit"),
        variants.get_key("v", "odd key").alias("odd"),
        variants.get_key("v", "n", "double").alias("n"),
        variants.get_key("v", "at", "timestamp_ntz").alias("at2"),
    ).first()
    assert row.asDict() == {
        "id": 7, "tag": "x", "gone": None, "at": dt.datetime(2022, 10, 15, 21, 41),
        "day": dt.date(2024, 2, 3), "unfit": None, "odd": "y", "n": 1.5,
        "at2": dt.datetime(2022, 10, 15, 21, 41),
    }


def test_flatten_drops_rows_without_elements(spark):
    docs = [(1, '{"a":[1,null,3]}'), (2, '{"a":[]}'), (3, '{"b":1}'), (4, '{"a":5}'), (5, None)]
    df = spark.createDataFrame(docs, "id int, d string").withColumn("v", variants.parse("d"))
    rows = variants.flatten(df, "v", "a", "item", position="at").select("id", "at").collect()
    assert [(r["id"], r["at"]) for r in rows] == [(1, 0), (1, 1), (1, 2)]


def test_text(spark):
    assert one(spark, text.product_name(F.lit("navy_blue_sweatsuit.png"))) == "Navy Blue Sweatsuit"
    assert one(spark, text.strip_text(F.lit("a\r\nb"), "\r\n")) == "ab"
    assert one(spark, text.join_or("none", "x: ", F.lit("a"), " & ", F.lit("b"))) == "x: a & b"
    assert one(spark, text.join_or("none", "x: ", F.lit(None).cast("string"))) == "none"
    assert one(spark, text.any_ilike(F.lit("JAMBA"), ["%juice%", "%jamba%"]))
    assert not one(spark, text.any_like(F.lit("JAMBA"), ["%jamba%"]))


def test_distance(spark):
    home, park = ("-104.97300245114094", "39.76471253574085"), ("-105.00840763333615", "39.754141917497826")
    metres = one(spark, geo.distance_to(*home, F.lit(park[0]), F.lit(park[1])))
    assert metres == pytest.approx(3245.8, abs=1.0)
    assert one(spark, geo.distance_to(*home, geo.make_point(*park))) == metres
    assert one(spark, geo.distance_to(*home, geo.make_point(*home))) == 0
    half_way_round = geo.distance(geo.make_point(0.0, 0.0), geo.make_point(180.0, 0.0))
    assert one(spark, half_way_round) == pytest.approx(3.141592653589793 * 6371008.8)
    nowhere = geo.make_point(F.lit(None).cast("double"), F.lit(1.0))
    assert one(spark, geo.distance(nowhere, geo.make_point(0.0, 0.0))) is None


def test_geometry_texts(spark):
    line = '{"coordinates":[[-105.5,39.25],[-104.0,40.0],[-104.5,38.5]],"type":"LineString"}'
    df = spark.createDataFrame([(line, "LINESTRING(-105.5 39.25,-104.0 40.0,-104.5 38.5)")], "j string, w string")
    trail = geo.from_geojson("j")
    row = df.select(
        geo.to_wkt(trail).alias("wkt"),
        (geo.from_wkt("w") == trail).alias("same"),
        geo.x_min(trail).alias("w"), geo.x_max(trail).alias("e"),
        geo.y_min(trail).alias("s"), geo.y_max(trail).alias("n"),
        geo.length(trail).alias("length"),
        (geo.distance(trail[0], trail[1]) + geo.distance(trail[1], trail[2])).alias("legs"),
    ).first()
    assert row["wkt"] == "LINESTRING(-105.5 39.25,-104.0 40.0,-104.5 38.5)"
    assert row["same"]
    assert (row["w"], row["e"], row["s"], row["n"]) == (-105.5, -104.0, 38.5, 40.0)
    assert row["length"] == pytest.approx(row["legs"])


def test_points_and_broken_geometries(spark):
    rows = [('{"coordinates":[1.0,2.0],"type":"Point"}', "POINT(1.0 2.0)"), ("x", "x"), (None, None)]
    df = spark.createDataFrame(rows, "j string, w string")
    got = df.select(
        geo.to_wkt(geo.from_geojson("j")).alias("j"), geo.to_wkt(geo.from_wkt("w")).alias("w"),
        geo.length(geo.from_wkt("w")).alias("n"),
    ).collect()
    assert [tuple(r) for r in got] == [("POINT(1.0 2.0)", "POINT(1.0 2.0)", 0.0), (None, None, None), (None, None, None)]


def test_bounding_box_ring(spark):
    sides = [F.lit(v) for v in ("1", "2", "3", "4")]
    assert one(spark, geo.box_wkt(*sides)) == "POLYGON((1 4,2 4,2 3,1 3))"
    assert one(spark, geo.box_wkt(*sides, closed=True)) == "POLYGON((1 4,2 4,2 3,1 3,1 4))"


def test_sql_function_and_variables(spark):
    sql_functions.register_add_three(spark, "bag_sum")
    assert spark.sql("SELECT bag_sum(4, 67, -39) AS x").first()["x"] == 32
    sql_functions.drop_function(spark, "bag_sum")
    with pytest.raises(Exception, match="bag_sum"):
        spark.sql("SELECT bag_sum(1, 2, 3)").collect()
    assert sql_functions.variables_sum(spark, var1=2, var2=6, var3=7) == 15
    assert one(spark, sql_functions.add_three(F.lit(1), F.lit(2), F.lit(None).cast("int"))) is None
