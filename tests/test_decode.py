from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import decode


@pytest.fixture(scope="module")
def lookups(spark):
    details = ["desc1", "desc2", "desc3", "desc4", "desc5", "engine", "drive_type", "transmission", "mpg"]
    models = spark.createDataFrame(
        [(7, "AJ4FX", "Model A"), (8, "AJ4FX", "other make"), (9, "UB2F3", "Model B")],
        "make_id int, vds string, model_name string",
    ).select("*", *[F.concat(F.lit(f"{d} of "), "model_name").alias(d) for d in details])
    return decode.Lookups(
        manufacturers=spark.createDataFrame(
            [("SAJ", 1, "Maker 1", "UK", "Car"), ("19U", 2, "Maker 2", "US", "Car")],
            "wmi string, manuf_id int, manuf_name string, country string, vehicle_type string",
        ),
        makes=spark.createDataFrame(
            [(1, "Make 7", 7), (2, "Make 9", 9)], "manuf_id int, make_name string, make_id int"
        ),
        plants=spark.createDataFrame(
            [(7, "C", "Plant C7"), (9, "C", "Plant C9"), (9, "A", "Plant A9")],
            "make_id int, plant_code string, plant_name string",
        ),
        years=spark.createDataFrame([("L", "2020")], "model_year_code string, model_year_name string"),
        models=models,
    )


KNOWN, SECOND, UNKNOWN = "SAJAJ4FX8LCP55916", "19UUB2F34LA001631", "5UXCR6C0XL9C77256"


def test_codes_of_a_known_number(spark):
    row = decode.parse_codes(spark.createDataFrame([(KNOWN,)], "vin string")).first()
    assert tuple(row) == (KNOWN, "SAJ", "AJ4FX", "L", "C")


def test_decode_uses_the_make_for_plant_and_model(spark, lookups):
    found = decode.decode(spark.createDataFrame([(KNOWN,), (SECOND,), (UNKNOWN,), (None,)], "vin string"), lookups)
    got = {r["vin"]: r for r in found.collect()}
    assert set(got) == {KNOWN, SECOND}
    assert (got[KNOWN]["plant_name"], got[KNOWN]["model_name"], got[KNOWN]["model_year"]) == ("Plant C7", "Model A", "2020")
    assert got[SECOND]["plant_name"] == "Plant A9" and got[SECOND]["engine"] == "engine of Model B"
    assert found.columns == ["vin", *decode.DECODED]


def stock(spark):
    rows = [(KNOWN, "red"), (SECOND, "blue"), (SECOND, "grey"), (UNKNOWN, "black"), ("", "none")]
    df = spark.createDataFrame(rows, "vin string, exterior string").withColumn("interior", F.lit("i"))
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in decode.DECODED])


def test_enrich_equals_one_update_per_number(spark, lookups):
    from lakeworks.operators.tables import update_from

    table = stock(spark)
    at_once = decode.enrich(table, lookups)
    step = table
    for vin in (KNOWN, SECOND, UNKNOWN, ""):
        source = decode.decode_one(step, lookups, vin).select("vin", *decode.ENRICHED).distinct()
        step = update_from(step, source, ["vin"], list(decode.ENRICHED))
    key = lambda r: str(tuple(r))
    assert sorted(at_once.collect(), key=key) == sorted(step.collect(), key=key)
    assert at_once.filter("model_name is not null").count() == 0
    assert at_once.filter("manuf_name is not null").count() == 3


def test_sql_table_function(spark, lookups):
    decode.register_decode(spark, lookups, "decode_vin")
    by_sql = spark.sql("SELECT * FROM decode_vin(:vin)", args={"vin": KNOWN})
    assert by_sql.collect() == decode.decode(spark.createDataFrame([(KNOWN,)], "vin string"), lookups).collect()
    stock(spark).createOrReplaceTempView("stock_rows")
    joined = spark.sql("SELECT s.exterior, f.make_name FROM stock_rows s, LATERAL decode_vin(s.vin) f")
    assert sorted(tuple(r) for r in joined.collect()) == [("blue", "Make 9"), ("grey", "Make 9"), ("red", "Make 7")]
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_decode_one(spark, lookups):
    got = decode.decode_one(stock(spark), lookups, SECOND).select("vin", "exterior", "make_name").collect()
    assert sorted(tuple(r) for r in got) == [(SECOND, "blue", "Make 9"), (SECOND, "grey", "Make 9")]
