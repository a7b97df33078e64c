"""Every registered query, bound to the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.functions import geo, network, sql_functions, temporal, text, variants
from lakeworks.operators import aggregates, decode, joins, ordering, sessions, storage, tables
from lakeworks.plans import (
    catalog,
    filetrips,
    gamelogs,
    geography,
    library,
    places,
    standins,
    stored,
    trails,
    weather,
)
from lakeworks.plans.standins import Tables
from lakeworks.schemas import struct
from lakeworks.session import cut_lineage, scratch_path
from lakeworks.sources.tables import literal_rows, project_cast

Query = Callable[[Tables], DataFrame]

# The place all distances are measured to.
HOME = (-104.97300245114094, 39.76471253574085)


def enhanced(t: Tables) -> DataFrame:
    return gamelogs.enhance(standins.logs(t), standins.keyed_locations(t))


def stored_events(t: Tables) -> DataFrame:
    """The enriched columns sessions need, written once and scanned several times."""
    return cut_lineage(enhanced(t).select("gamer_name", "game_event_ltz", "tod_name"), "enhanced")


# game logs -----------------------------------------------------------------


def ip_to_int(t: Tables) -> DataFrame:
    return standins.logs(t).select("ip_address", network.ip_to_int("ip_address").alias("ip_int"))


def ip_lookup_one(t: Tables) -> DataFrame:
    wanted = network.ip_to_int("'10.3.8.0'")
    found = standins.locations(t).filter(wanted.between(F.col("start_ip_int"), F.col("end_ip_int")))
    return found.select(
        "start_ip", "end_ip", "start_ip_int", "end_ip_int", "city", "region", "country", "timezone"
    )


_LOCATED = (
    "ip_address", "user_login", "user_event", "datetime_iso8601", "city", "region", "country", "timezone",
)


def ip_range_join(t: Tables) -> DataFrame:
    return joins.ip_range_join(standins.logs(t), standins.locations(t)).select(*_LOCATED)


def ip_range_join_keyed(t: Tables) -> DataFrame:
    return joins.keyed_ip_join(standins.logs(t), standins.keyed_locations(t)).select(*_LOCATED)


def _event_hours(t: Tables) -> DataFrame:
    lookup = F.broadcast(temporal.time_of_day_lookup(t.spark))  # 24 rows, always
    return t.events.select(F.hour("ts").alias("hour")).join(lookup, "hour")


def time_of_day_lookup(t: Tables) -> DataFrame:
    return _event_hours(t).groupBy("hour", "tod_name").agg(F.count("*").alias("n_events"))


def listagg_by_group(t: Tables) -> DataFrame:
    return gamelogs.hours_by_name(_event_hours(t).distinct())


def merge_insert(t: Tables) -> DataFrame:
    rows = enhanced(t)
    early = rows.filter(F.col("game_event_utc") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return gamelogs.merge_new(early.withColumn("ip_address", F.lit("kept")), rows)


def merge_update(t: Tables) -> DataFrame:
    clicks = standins.logs(t).filter(F.col("user_event") == "click")
    return gamelogs.mark_known(
        enhanced(t), clicks, ip_address=F.lit("set by merge")
    )


def delete_where(t: Tables) -> DataFrame:
    return tables.delete_where(enhanced(t), F.col("gamer_name") == "user_7")


def insert_select(t: Tables) -> DataFrame:
    def parsed(raw: DataFrame) -> DataFrame:
        return gamelogs.parse_logs(raw).select("user_event", "user_login", "datetime_iso8601")

    fields = F.struct(
        F.col("event_type").alias("user_event"),
        F.col("user_id").cast("string").alias("user_login"),
        F.col("ts").cast("string").alias("datetime_iso8601"),
    )
    landed = t.events.select(F.try_parse_json(F.to_json(fields)).alias("raw_log"))
    literal = (
        '{"datetime_iso8601":"2025-01-01 00:00:00.000","user_event":"fake event","user_login":"fake user"}'
    )
    added = literal_rows(t.spark, [(literal,)], log="string")
    return parsed(landed.unionByName(added.select(variants.parse("log").alias("raw_log"))))


def row_tallies(t: Tables) -> DataFrame:
    expected = F.max("event_id") - F.min("event_id") + 1
    stages = {
        "raw": (t.events, expected),
        "logs": (standins.logs(t), None),
        "enhanced": (enhanced(t), None),
    }
    return aggregates.row_tallies(stages)


def max_case_tally(t: Tables) -> DataFrame:
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return aggregates.any_match(t.orders, urgent, "tally")


# geography -----------------------------------------------------------------


def left_join_upper(t: Tables) -> DataFrame:
    def codes(rows: DataFrame, name: str, letter: str, key: str) -> DataFrame:
        return rows.select(
            F.lower(name).alias("iso_country_name"),
            F.concat(F.lit("Official "), name).alias("country_name_official"),
            F.concat(F.lit(letter), F.col(key).cast("string")).alias("alpha_code_2digit"),
        )

    iso = codes(t.nation, "n_name", "C", "n_nationkey").unionByName(
        codes(t.supplier, "s_name", "S", "s_nationkey")
    )
    return geography.countries_with_region(iso, t.nation, t.region)


# weather -------------------------------------------------------------------


def _codes(t: Tables) -> DataFrame:
    return weather.mailing_codes(standins.history(t), "F", "12%", "13%")


def avg_per_day(t: Tables) -> DataFrame:
    days = weather.cloud_cover_per_day(standins.forecast(t), _codes(t))
    return days.withColumn("avg_cloud_cover", F.round("avg_cloud_cover", 6))


# vehicles ------------------------------------------------------------------


def vin_parse(t: Tables) -> DataFrame:
    return decode.parse_codes(standins.vehicles(t).select("vin"))


def vin_decode(t: Tables) -> DataFrame:
    return decode.decode(standins.vehicles(t), standins.vehicle_lookups(t))


def star_decode(t: Tables) -> DataFrame:
    return vin_decode(t).groupBy("make_name", "model_year").agg(F.count("*").alias("n_vehicles"))


def implicit_join(t: Tables) -> DataFrame:
    """Stock joined with the decoded rows of the same number."""
    stock = standins.vehicles(t).select("vin", "exterior", "interior").distinct()
    found = vin_decode(t).select("vin", "manuf_name", "make_name", "model_year").distinct()
    return stock.join(found, "vin")


def update_from_join(t: Tables) -> DataFrame:
    return decode.enrich(standins.lot_stock(t), standins.vehicle_lookups(t))


def load_by_name(t: Tables) -> DataFrame:
    file_rows = t.part.select(
        F.col("p_size").alias("Shelf"),
        F.col("p_name").alias("FRUIT_Name"),
        F.col("p_partkey").alias("Fruit_Id"),
        F.col("p_brand").alias("not_in_table"),
    )
    table = struct(fruit_id="bigint", fruit_name="string", search_on="string", shelf="int")
    return tables.conform(file_rows, table)


# catalogue -----------------------------------------------------------------


def product_name_clean(t: Tables) -> DataFrame:
    file_name = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit(".png"))
    return t.part.select("p_name", text.product_name(file_name).alias("product_name"))


def cross_join_sizes(t: Tables) -> DataFrame:
    names, sizes = t.part.select("p_name").distinct(), t.part.select("p_size").distinct()
    return joins.every_combination(names, sizes)


def catalog_for_website(t: Tables) -> DataFrame:
    listed = catalog.product_list(standins.image_files(t), standins.suits(t))
    return catalog.catalog_for_website(
        listed,
        standins.suit_sizes(t),
        standins.upsell_mapping(t),
        standins.coordination(t),
        standins.accessory_lines(t),
    )


def param_lookup(t: Tables) -> DataFrame:
    return catalog.product_of_style(catalog_for_website(t), "Brand#7")


def lateral_alias(t: Tables) -> DataFrame:
    """Later items of one SELECT use earlier aliases."""
    return t.spark.sql(
        "SELECT concat(replace(p_name, ' ', '_'), '.png') AS relative_path,"
        " replace(relative_path, '_', ' ') AS no_underscores_filename,"
        " replace(no_underscores_filename, '.png') AS just_words_filename FROM {part}",
        part=t.part,
    )


def alias_in_where(t: Tables) -> DataFrame:
    """A filter on a computed column: compute first, then filter."""
    squeezed = t.part.select(text.strip_text("p_name", " ").alias("squeezed"))
    return squeezed.filter(F.col("squeezed") != "redwidget")


def like_ilike_in(t: Tables) -> DataFrame:
    kinds = F.col("c_mktsegment").isin("FURNITURE", "BUILDING")
    named = text.any_ilike(F.col("c_name"), ["%customer%7", "%13%"])
    in_debt = F.col("c_mktsegment").like("AUTO%") & (F.col("c_acctbal") <= 0)
    return t.customer.filter((kinds & named) | in_debt).select("c_custkey", "c_name")


# trails and places ---------------------------------------------------------


def _points(t: Tables) -> DataFrame:
    return trails.trail_points(standins.trail_raw(t))


def parquet_project_cast(t: Tables) -> DataFrame:
    typed = project_cast(
        t.events,
        {
            "sequence_1": ("event_id", "bigint"),
            "trail_name": ("event_type", "string"),
            "sequence_2": ("user_id", "string"),
            "latitude": ("value", "decimal(11,8)"),
        },
    )
    return typed.withColumn("latitude", F.col("latitude").cast("string"))


def listagg_ordered(t: Tables) -> DataFrame:
    return aggregates.ordered_text(
        _points(t), ["trail_name"], F.col("coord_pair"), ",", "coord_pairs", order=F.col("point_id")
    )


def trail_length(t: Tables) -> DataFrame:
    return trails.trail_lengths(_points(t)).withColumn("trail_length", F.round("trail_length", 3))


def _all_trails(t: Tables) -> DataFrame:
    return trails.all_trails(
        trails.trails_from_documents(standins.trail_documents(t)),
        trails.trails_from_points(_points(t)),
    )


def _all_bounds(t: Tables) -> DataFrame:
    documents = trails.boundaries(trails.trails_from_documents(standins.trail_documents(t)))
    return documents.drop("my_linestring").unionByName(trails.boundaries_from_points(_points(t)))


def union_all_sources(t: Tables) -> DataFrame:
    wkt = geo.to_wkt(geo.from_geojson("geometry"))
    return _all_trails(t).select("feature_name", wkt.alias("wkt"))


def trail_bounds(t: Tables) -> DataFrame:
    return _all_bounds(t).withColumn("trail_length", F.round("trail_length", 3))


def bbox_polygon(t: Tables) -> DataFrame:
    return trails.bounding_polygon(_all_bounds(t))


def geo_distance(t: Tables) -> DataFrame:
    measured = trails.with_distance(_points(t), *HOME, "distance")
    return measured.select("point_id", F.round("distance", 3).alias("distance"))


def geo_wkt(t: Tables) -> DataFrame:
    return places.wkt_of(standins.places(t)).select("place_id", "wkt")


def nearest_places(t: Tables) -> DataFrame:
    found = places.competitors(
        standins.places(t),
        amenities=["FURNITURE", "BUILDING"],
        names=["%customer%7", "%13%"],
        cuisines=["%HOUSE%;1%", "MACH%;2"],
    )
    ranked = places.nearest_first(found, *HOME, "metres", ["place_id"])
    return ranked.select("place_id", "name", "cuisine", F.round("metres", 3).alias("metres"))


# variants ------------------------------------------------------------------


def json_path_extract(t: Tables) -> DataFrame:
    nested = F.to_json(F.struct(F.array(F.struct(F.col("event_type").alias("text"))).alias("tags")))
    parsed = t.events.select(
        "event_id", variants.parse("props").alias("v"), variants.parse(nested).alias("n")
    )
    return parsed.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        variants.path("v", "k", "bigint").alias("k"),
        variants.get_key("v", "k").alias("k_text"),
        variants.path("v", "nothing").alias("missing"),
        variants.path("n", "tags[0].text").alias("first_tag"),
    )


def flatten_positions(t: Tables) -> DataFrame:
    vectors = t.embeddings.select(
        "vec_id", F.try_parse_json(F.to_json(F.struct("embedding"))).alias("v")
    )
    each = variants.flatten(vectors, "v", "embedding", "item", position="position")
    component = F.try_variant_get("item", "$", "double")
    return each.select(
        "vec_id", F.col("position").cast("bigint").alias("position"), component.alias("component")
    )


# tables --------------------------------------------------------------------


def load_transform(t: Tables) -> DataFrame:
    target = t.part.select(F.col("p_partkey").alias("fruit_id"), F.col("p_name").alias("fruit_name"))
    load = t.supplier.select(F.col("s_name").alias("fruit_name"), F.col("s_suppkey").alias("fruit_id"))
    return tables.append(target, load)


def ctas_top_n(t: Tables) -> DataFrame:
    ranked = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return storage.create_as(ranked, scratch_path(t.spark, "top-orders"), rows=100)


def update_where(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    changed = tables.update_where(
        rows,
        F.col("o_orderstatus") == "P",
        o_orderpriority=F.lit("pending"),
        o_totalprice=F.lit(0.0),
    )
    return changed.drop("o_orderstatus")


def snapshot_copy(t: Tables) -> DataFrame:
    return storage.snapshot(t.customer, scratch_path(t.spark, "customer-copy"))


def schema_evolve(t: Tables) -> DataFrame:
    wide = tables.add_column(t.customer.select("c_custkey", "c_name", "c_acctbal"), "order_filled", "boolean", False)
    renamed = tables.rename_column(wide, "c_custkey", "customer_id")
    return tables.drop_column(renamed, "c_acctbal")


def number_rows(t: Tables) -> DataFrame:
    numbered = tables.number_rows(t.lineitem.select("l_orderkey"), "n")
    return numbered.agg(
        F.count("*").alias("n_rows"),
        F.min("n").alias("first_key"),
        F.max("n").alias("last_key"),
        F.count_distinct("n").alias("n_keys"),
    )


def udf_sum3(t: Tables) -> DataFrame:
    sql_functions.register_add_three(t.spark, "add_three")
    total = F.expr("add_three(p_partkey, p_size, p_retailprice)").cast("double")
    return t.part.select("p_partkey", total.alias("total"))


def column_defaults(t: Tables) -> DataFrame:
    """A column the rows leave out gets its default; a NULL they state is kept."""
    stated = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    rows = t.orders.select("o_orderkey", stated.alias("o_orderstatus"))
    return tables.fill_defaults(rows, o_orderstatus=F.lit("new"), order_filled=F.lit(False))


def next_in_cut_groups(t: Tables) -> DataFrame:
    """Next event of each type, some without a time; every type is cut into many slices."""
    time = F.when(F.col("event_id") % 50 != 0, F.col("event_id"))
    rows = t.events.select("event_type", time.alias("at"), "event_id")
    found = ordering.with_next(rows, ["event_type"], "at", {"next_at": "at"}, F.col("at"), group_rows=300)
    return found.filter("at is not null").select("event_type", "at", "next_at")


QUERIES: dict[str, Query] = {
    "logs_enhanced": enhanced,
    "ip_to_int": ip_to_int,
    "ip_lookup_one": ip_lookup_one,
    "ip_range_join": ip_range_join,
    "ip_range_join_keyed": ip_range_join_keyed,
    "session_lengths": lambda t: sessions.session_lengths(stored_events(t)),
    "session_heatgrid": lambda t: sessions.session_grid(stored_events(t)),
    "session_heatgrid_rows": lambda t: sessions.session_grid_rows(stored_events(t)),
    "login_logout_rollup": lambda t: gamelogs.login_and_logout(enhanced(t)),
    "time_of_day_lookup": time_of_day_lookup,
    "listagg_by_group": listagg_by_group,
    "merge_insert": merge_insert,
    "merge_update": merge_update,
    "delete_where": delete_where,
    "insert_select": insert_select,
    "row_tallies": row_tallies,
    "max_case_tally": max_case_tally,
    "nation_list": lambda t: t.nation.select("n_nationkey", "n_name", "n_regionkey"),
    "region_list": lambda t: t.region.select("r_regionkey", "r_name"),
    "region_nation": lambda t: geography.nations_with_region(t.nation, t.region),
    "countries_per_region": lambda t: geography.countries_per_region(t.nation, t.region),
    "distinct_segment": lambda t: t.customer.select("c_mktsegment").distinct(),
    "segment_counts": lambda t: geography.segment_counts(t.customer),
    "left_join_upper": left_join_upper,
    "and_or_precedence": _codes,
    "filter_reduction": lambda t: weather.counts_before_and_after(standins.history(t), _codes(t)),
    "semi_filter_count": lambda t: weather.rows_for_codes(standins.history(t), _codes(t)),
    "date_span": lambda t: weather.date_span(standins.forecast(t), _codes(t)),
    "avg_per_day": avg_per_day,
    "vin_parse": vin_parse,
    "vin_decode": vin_decode,
    "star_decode": star_decode,
    "implicit_join": implicit_join,
    "update_from_join": update_from_join,
    "load_by_name": load_by_name,
    "product_name_clean": product_name_clean,
    "cross_join_sizes": cross_join_sizes,
    "catalog_for_website": catalog_for_website,
    "param_lookup": param_lookup,
    "lateral_alias": lateral_alias,
    "alias_in_where": alias_in_where,
    "like_ilike_in": like_ilike_in,
    "parquet_project_cast": parquet_project_cast,
    "coord_pair": lambda t: trails.points_wkt(_points(t)),
    "listagg_ordered": listagg_ordered,
    "linestring_build": lambda t: trails.linestrings(_points(t)),
    "trail_length": trail_length,
    "trail_bounds": trail_bounds,
    "union_all_sources": union_all_sources,
    "bbox_polygon": bbox_polygon,
    "geo_distance": geo_distance,
    "geo_wkt": geo_wkt,
    "nearest_places": nearest_places,
    "json_path_extract": json_path_extract,
    "json_filter_present": lambda t: library.with_hashtags(standins.posts(t)),
    "flatten_array": lambda t: library.hashtags_normalized(standins.posts(t)),
    "flatten_positions": flatten_positions,
    "load_transform": load_transform,
    "ctas_top_n": ctas_top_n,
    "update_where": update_where,
    "snapshot_copy": snapshot_copy,
    "schema_evolve": schema_evolve,
    "unique_check": lambda t: aggregates.duplicate_keys(t.orders, ["o_custkey"]),
    "number_rows": number_rows,
    "udf_sum3": udf_sum3,
    "two_header_rows": filetrips.two_header_rows,
    "caret_records": filetrips.caret_records,
    "comma_file": filetrips.comma_file,
    "tab_file": filetrips.tab_file,
    "semicolon_records": filetrips.semicolon_records,
    "json_lines": filetrips.json_lines,
    "append_then_truncate": filetrips.append_then_truncate,
    "column_defaults": column_defaults,
    "next_in_cut_groups": next_in_cut_groups,
    "quoted_carriage_returns": filetrips.quoted_carriage_returns,
    "bad_records": filetrips.bad_records,
    "file_rows": filetrips.file_rows,
    "files_and_rows": filetrips.files_and_rows,
    "json_arrays": filetrips.json_arrays,
    "json_elements": filetrips.json_elements,
    "quoted_line_breaks": filetrips.quoted_line_breaks,
    "incremental_load": filetrips.incremental_load,
    **stored.QUERIES,
}


def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    """A query as the ``(session, folder)`` callable the driver expects."""
    return lambda spark, folder: query(Tables(spark, folder))
