"""The supplied tables in the shape the queries expect.

Each function derives one input from whole supplied tables, so its size grows
with them.  Lookups leave some codes out on purpose, so that joins miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.functions.network import ip_to_int
from lakeworks.operators.decode import Lookups
from lakeworks.operators.joins import with_join_keys
from lakeworks.sources.tables import shared_table

# Time zone standing in for each region key.
ZONES = {
    0: "Africa/Nairobi",
    1: "America/Denver",
    2: "Asia/Tokyo",
    3: "Europe/Berlin",
    4: "Asia/Dubai",
}

# Model year codes in order, from 1980 on.
YEAR_CODES = "ABCDEFGHJKLMNPRSTVWXY123456789"

#: Points per stand-in trail.
TRAIL_POINTS = 500


class Tables:
    """The supplied tables of one folder, each opened once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = shared_table(self.spark, self.folder, name)
        setattr(self, name, table)
        return table


# game logs -----------------------------------------------------------------


def logs(t: Tables) -> DataFrame:
    """Events as game logs with an address made from their ids."""
    return t.events.selectExpr(
        "concat('10.', user_id % 25, '.', event_id % 256, '.', user_id % 250) AS ip_address",
        "concat('user_', user_id) AS user_login",
        "event_type AS user_event",
        "ts AS datetime_iso8601",
    )


def locations(t: Tables) -> DataFrame:
    """Address ranges per nation, plus one range across two prefixes."""
    zone = " ".join(f"WHEN {key} THEN '{name}'" for key, name in ZONES.items())
    nations = t.nation.selectExpr(
        "n_nationkey AS k",
        "concat('City ', n_name) AS city",
        "concat('Region ', n_regionkey) AS region",
        "n_name AS country",
        f"CASE n_regionkey {zone} END AS timezone",
    )
    place = ["city", "region", "country", "timezone"]
    plain = nations.filter("k % 5 <> 4").selectExpr(
        "concat('10.', k, '.0.0') AS start_ip", "concat('10.', k, '.199.255') AS end_ip", *place
    )
    wide = nations.filter("k = 3").selectExpr(
        "concat('10.', k, '.200.0') AS start_ip", "concat('10.', k + 1, '.99.255') AS end_ip", *place
    )
    return plain.unionByName(wide).select(
        "*", ip_to_int("start_ip").alias("start_ip_int"), ip_to_int("end_ip").alias("end_ip_int")
    )


def keyed_locations(t: Tables) -> DataFrame:
    return with_join_keys(locations(t))


# weather -------------------------------------------------------------------


def history(t: Tables) -> DataFrame:
    """Orders as daily weather: status as country, customer as postal code."""
    return t.orders.select(
        F.col("o_orderstatus").alias("country"),
        F.col("o_custkey").cast("string").alias("postal_code"),
        F.to_date("o_orderdate").alias("date_valid_std"),
    )


def forecast(t: Tables) -> DataFrame:
    """Line items as forecast: part as postal code, discount as cloud cover."""
    return t.lineitem.select(
        F.col("l_partkey").cast("string").alias("postal_code"),
        F.to_date("l_shipdate").alias("date_valid_std"),
        (F.col("l_discount") * 100).alias("avg_cloud_cover_tot_pct"),
    )


# vehicles ------------------------------------------------------------------


def vehicles(t: Tables) -> DataFrame:
    """Parts as stock with a vehicle number that ends in the whole key: six digits, more above a million parts."""
    number = (
        "concat('W', lpad(substr(p_brand, 7, 2), 2, '0'), rpad(upper(substr(p_type, 1, 5)), 5, 'X'), '0', "
        f"substr('{YEAR_CODES}', p_size % 30 + 1, 1), "
        "substr('ABCDE', CAST(p_partkey % 5 + 1 AS INT), 1), "
        "lpad(CAST(p_partkey AS STRING), greatest(6, length(CAST(p_partkey AS STRING))), '0'))"
    )
    return t.part.selectExpr(
        f"{number} AS vin",
        "split_part(p_name, ' ', 1) AS exterior",
        "split_part(p_name, ' ', 2) AS interior",
        "p_brand",
        "p_type",
        "p_size",
    )


def vehicle_lookups(t: Tables) -> Lookups:
    """The five decode tables, from the codes that occur."""
    codes = vehicles(t).selectExpr(
        "substr(vin, 1, 3) AS wmi",
        "CAST(substr(vin, 2, 2) AS INT) AS manuf_id",
        "CAST(substr(vin, 2, 2) AS INT) % 5 AS make_id",
        "substr(vin, 4, 5) AS vds",
        "substr(vin, 10, 1) AS model_year_code",
        "substr(vin, 11, 1) AS plant_code",
    )
    manufacturers = codes.select("wmi", "manuf_id").distinct().filter("manuf_id % 7 <> 0").selectExpr(
        "*",
        "concat('Maker ', manuf_id) AS manuf_name",
        "concat('Country ', manuf_id % 4) AS country",
        "CASE WHEN manuf_id % 2 = 0 THEN 'Passenger Car' ELSE 'Truck' END AS vehicle_type",
    )
    makes = codes.select("manuf_id", "make_id").distinct().selectExpr(
        "manuf_id", "concat('Make ', make_id) AS make_name", "make_id"
    )
    plants = (
        codes.select("make_id", "plant_code")
        .distinct()
        .filter("NOT (make_id = 2 AND plant_code = 'C')")
        .selectExpr("*", "concat('Plant ', plant_code, '-', make_id) AS plant_name")
    )
    years = codes.select("model_year_code").distinct().selectExpr(
        "*", f"CAST(instr('{YEAR_CODES}', model_year_code) + 1979 AS STRING) AS model_year_name"
    )
    details = ("desc1", "desc2", "desc3", "desc4", "desc5", "body_style", "engine", "drive_type",
               "transmission", "mpg")
    models = (
        codes.select("make_id", "vds")
        .distinct()
        .filter("NOT (make_id = 1 AND vds = 'PROMO')")
        .selectExpr(
            "*",
            "concat('Model ', vds, '-', make_id) AS model_name",
            *[f"concat('{d} ', vds, '-', make_id) AS {d}" for d in details],
        )
    )
    return Lookups(manufacturers, makes, plants, years, models)


def lot_stock(t: Tables) -> DataFrame:
    """Vehicles as stock rows: the large ones decoded by hand, the rest not at all."""
    from lakeworks.operators.decode import DECODED

    known = F.col("p_size") > 40
    return vehicles(t).select(
        "vin",
        "exterior",
        "interior",
        *[F.when(known, F.lit(f"by hand {c}")).cast("string").alias(c) for c in DECODED],
    )


# catalogue -----------------------------------------------------------------


FILE_NAME = "concat(replace(p_name, ' ', '_'), '.png')"


def image_files(t: Tables) -> DataFrame:
    """One file per part name."""
    names = t.part.selectExpr(f"{FILE_NAME} AS relative_path").distinct()
    return names.selectExpr("relative_path", "concat('/images/', relative_path) AS file_url")


def suits(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_brand AS color_or_style", f"{FILE_NAME} AS file_name", "p_retailprice AS price"
    )


def suit_sizes(t: Tables) -> DataFrame:
    return t.part.selectExpr("lpad(CAST(p_size AS STRING), 2, '0') AS sizes_available").distinct()


def _brand_codes(t: Tables, up_to: int) -> DataFrame:
    brands = t.part.selectExpr("p_brand", "CAST(substr(p_brand, 7, 2) AS INT) AS k").distinct()
    return brands.filter(f"k <= {up_to}").selectExpr("*", "concat('SWT_', k) AS code")


def upsell_mapping(t: Tables) -> DataFrame:
    return _brand_codes(t, 18).selectExpr(
        "p_brand AS sweatsuit_color_or_style", "code AS upsell_product_code"
    )


def coordination(t: Tables) -> DataFrame:
    return _brand_codes(t, 15).selectExpr("code AS product_code", "p_brand AS has_matching_sweatsuit")


def accessory_lines(t: Tables) -> DataFrame:
    return _brand_codes(t, 12).selectExpr(
        "code AS product_code",
        "concat('Headband ', k) AS headband_description",
        "concat('Wristband ', k) AS wristband_description",
    )


# trails and places ---------------------------------------------------------


def trail_raw(t: Tables) -> DataFrame:
    """Events as trail points in id order, with the two axes under swapped names."""
    return t.events.select(
        F.col("event_id").alias("sequence_1"),
        F.concat(
            F.lit("trail_"), F.floor(F.col("event_id") / TRAIL_POINTS).cast("string")
        ).alias("trail_name"),
        (F.lit(-105.0) + (F.col("event_id") % 20000) / F.lit(100000.0)).alias("latitude"),
        (F.lit(39.0) + F.col("value") / F.lit(1000.0)).alias("longitude"),
    )


def trail_documents(t: Tables) -> DataFrame:
    """Orders as GeoJSON feature collections, one per block of orders."""
    from lakeworks.functions import geo
    from lakeworks.operators.aggregates import ordered_text

    points = t.orders.select(
        F.floor(F.col("o_orderkey") / TRAIL_POINTS).alias("block"),
        "o_orderkey",
        geo.coordinate(F.lit(-105.0) + (F.col("o_custkey") % 20000) / F.lit(100000.0)).alias("lng"),
        geo.coordinate(F.lit(39.0) + (F.col("o_orderkey") % 997) / F.lit(10000.0)).alias("lat"),
    )
    lines = ordered_text(
        points, ["block"], geo.json_pair(F.col("lng"), F.col("lat")), ",", "pairs", order=F.col("o_orderkey")
    )
    document = F.concat(
        F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"CRS84"}},'
              '"features":[{"type":"Feature","properties":{"Name":"orders_'),
        F.col("block").cast("string"),
        F.lit('"},"geometry":'),
        geo.linestring_geojson(F.col("pairs")),
        F.lit("}]}"),
    )
    return lines.select(F.try_parse_json(document).alias("whole_object"))


def places(t: Tables) -> DataFrame:
    """Customers as places."""
    from lakeworks.functions import geo

    return t.customer.select(
        F.col("c_custkey").alias("place_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("amenity"),
        F.concat_ws(";", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("cuisine"),
        geo.make_point(
            F.lit(-105.0) + (F.col("c_custkey") % 20000) / F.lit(100000.0),
            F.lit(39.7) + F.col("c_acctbal") / F.lit(100000.0),
        ).alias("coordinates"),
    )


# variants ------------------------------------------------------------------


def posts(t: Tables) -> DataFrame:
    """Benchmark texts and events as posts: words as hashtags, some without any."""
    tags = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("text")))
    texts = t.benchmark.select(
        F.col("item_id").alias("id"),
        F.struct((F.col("item_id") % 7).alias("id")).alias("user"),
        F.lit("2024-01-01").alias("created_at"),
        F.struct(tags.alias("hashtags")).alias("entities"),
    )
    kinds = F.when(
        F.col("event_type") != "error", F.array(F.struct(F.col("event_type").alias("text")))
    )
    events = t.events.select(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.to_date("ts").cast("string").alias("created_at"),
        F.struct(kinds.alias("hashtags")).alias("entities"),
    )
    both = texts.unionByName(events)
    return both.select(F.try_parse_json(F.to_json(F.struct("*"))).alias("raw_status"))
