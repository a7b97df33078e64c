"""The registered queries once more, as SQL text for an independent engine."""

from __future__ import annotations

from lakeworks.functions.temporal import TIME_OF_DAY
from lakeworks.operators.sessions import LENGTH_BUCKETS, LONGEST_BUCKET
from lakeworks.plans.catalog import NO_ACCESSORY
from lakeworks.plans.filetrips import FEW_FILES, FILE_KEYS
from lakeworks.plans.standins import TRAIL_POINTS, YEAR_CODES, ZONES
from lakeworks.plans.stored import ORACLES as STORED

# --- shared fragments -------------------------------------------------------


def with_parts(query: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)} {query}"


def _width(table: str, key: str) -> str:
    """Keys of a file, as the file trips deal them."""
    return f"(SELECT least({FILE_KEYS}, greatest(1, (max({key}) + {FEW_FILES}) // {FEW_FILES})) FROM {table})"


def ip_number(ip: str) -> str:
    weights = (16777216, 65536, 256, 1)
    terms = (f"CAST(split_part({ip}, '.', {i}) AS BIGINT) * {w}" for i, w in enumerate(weights, 1))
    return " + ".join(terms)


def haversine(lng_a: str, lat_a: str, lng_b: str, lat_b: str) -> str:
    half_lat = f"pow(sin((radians({lat_b}) - radians({lat_a})) / 2), 2)"
    half_lng = f"pow(sin((radians({lng_b}) - radians({lng_a})) / 2), 2)"
    chord = f"{half_lat} + cos(radians({lat_a})) * cos(radians({lat_b})) * {half_lng}"
    return f"2 * 6371008.8 * asin(sqrt(CASE WHEN {chord} > 1 THEN 1 ELSE {chord} END))"


LOGS = """
logs AS (
  SELECT '10.' || (user_id % 25) || '.' || (event_id % 256) || '.' || (user_id % 250) AS ip_address,
         'user_' || user_id AS user_login, event_type AS user_event, ts AS datetime_iso8601
  FROM events)"""

_ZONE = " ".join(f"WHEN {key} THEN '{zone}'" for key, zone in ZONES.items())

LOC = f"""
nat AS (
  SELECT n_nationkey AS k, n_name AS country, 'Region ' || n_regionkey AS region,
         CASE n_regionkey {_ZONE} END AS timezone
  FROM nation),
loc_text AS (
  SELECT '10.' || k || '.0.0' AS start_ip, '10.' || k || '.199.255' AS end_ip, nat.* FROM nat WHERE k % 5 <> 4
  UNION ALL
  SELECT '10.' || k || '.200.0', '10.' || (k + 1) || '.99.255', nat.* FROM nat WHERE k = 3),
loc AS (
  SELECT start_ip, end_ip, 'City ' || country AS city, region, country, timezone,
         {ip_number("start_ip")} AS start_ip_int, {ip_number("end_ip")} AS end_ip_int
  FROM loc_text)"""

TOD = f"""
tod(hour, tod_name) AS (VALUES {", ".join(f"({h}, '{n}')" for h, n in TIME_OF_DAY)})"""

LOCATED = f"""
located AS (
  SELECT logs.*, loc.city, loc.region, loc.country, loc.timezone
  FROM logs JOIN loc ON {ip_number("ip_address")} BETWEEN start_ip_int AND end_ip_int)"""

ENH = """
timed AS (
  SELECT *, (datetime_iso8601 AT TIME ZONE 'UTC') AT TIME ZONE timezone AS game_event_ltz FROM located),
enh AS (
  SELECT ip_address, user_login AS gamer_name, user_event AS game_event_name,
         datetime_iso8601 AS game_event_utc, city, region, country, timezone AS gamer_ltz_name,
         game_event_ltz, strftime(game_event_ltz, '%a') AS dow_name, tod_name
  FROM timed JOIN tod ON extract(hour FROM game_event_ltz) = tod.hour)"""

ENHANCED = (LOGS, LOC, TOD, LOCATED, ENH)

LENGTH_CASE = (
    "CASE " + " ".join(f"WHEN game_session_length < {most} THEN '{name}'" for most, name in LENGTH_BUCKETS) + f" ELSE '{LONGEST_BUCKET}' END"
)

SESSIONS = """
sess AS (
  SELECT gamer_name, tod_name, game_event_ltz AS login,
         lead(game_event_ltz) OVER (PARTITION BY gamer_name ORDER BY game_event_ltz) AS logout
  FROM enh),
sessions AS (
  SELECT *, coalesce(date_diff('minute', login, logout), 0) AS game_session_length FROM sess),
grid AS (
  SELECT """ + LENGTH_CASE + """ AS session_length, tod_name
  FROM sessions WHERE logout IS NOT NULL)"""

HISTORY = """
history AS (
  SELECT o_orderstatus AS country, CAST(o_custkey AS VARCHAR) AS postal_code,
         CAST(o_orderdate AS DATE) AS date_valid_std FROM orders),
codes AS (
  SELECT DISTINCT postal_code FROM history
  WHERE country = 'F' AND postal_code LIKE '12%' OR postal_code LIKE '13%')"""

FORECAST = """
forecast AS (
  SELECT CAST(l_partkey AS VARCHAR) AS postal_code, CAST(l_shipdate AS DATE) AS date_valid_std,
         l_discount * 100 AS avg_cloud_cover_tot_pct FROM lineitem)"""

VEHICLES = f"""
vehicles AS (
  SELECT 'W' || lpad(substr(p_brand, 7, 2), 2, '0') || rpad(upper(left(p_type, 5)), 5, 'X') || '0'
         || substr('{YEAR_CODES}', p_size % 30 + 1, 1) || substr('ABCDE', p_partkey % 5 + 1, 1)
         || lpad(CAST(p_partkey AS VARCHAR), greatest(6, length(CAST(p_partkey AS VARCHAR)))::INT, '0') AS vin,
         split_part(p_name, ' ', 1) AS exterior, split_part(p_name, ' ', 2) AS interior,
         p_brand, p_type, p_size, p_partkey
  FROM part)"""

_DETAILS = ("desc1", "desc2", "desc3", "desc4", "desc5", "body_style", "engine", "drive_type",
            "transmission", "mpg")
_DETAIL_SQL = ", ".join(f"'{d} ' || vds || '-' || make_id AS {d}" for d in _DETAILS)

LOOKUPS = f"""
brands AS (SELECT DISTINCT left(vin, 3) AS wmi, CAST(substr(vin, 2, 2) AS INT) AS manuf_id FROM vehicles),
manufacturers AS (
  SELECT wmi, manuf_id, 'Maker ' || manuf_id AS manuf_name,
         CASE WHEN manuf_id % 2 = 0 THEN 'Passenger Car' ELSE 'Truck' END AS vehicle_type
  FROM brands WHERE manuf_id % 7 <> 0),
makes AS (SELECT manuf_id, 'Make ' || (manuf_id % 5) AS make_name, manuf_id % 5 AS make_id FROM brands),
plants AS (
  SELECT make_id, plant_code, 'Plant ' || plant_code || '-' || make_id AS plant_name
  FROM (SELECT DISTINCT CAST(substr(vin, 2, 2) AS INT) % 5 AS make_id, substr(vin, 11, 1) AS plant_code
        FROM vehicles)
  WHERE NOT (make_id = 2 AND plant_code = 'C')),
years AS (
  SELECT model_year_code, CAST(strpos('{YEAR_CODES}', model_year_code) + 1979 AS VARCHAR) AS model_year_name
  FROM (SELECT DISTINCT substr(vin, 10, 1) AS model_year_code FROM vehicles)),
models AS (
  SELECT make_id, vds, 'Model ' || vds || '-' || make_id AS model_name, {_DETAIL_SQL}
  FROM (SELECT DISTINCT CAST(substr(vin, 2, 2) AS INT) % 5 AS make_id, substr(vin, 4, 5) AS vds FROM vehicles)
  WHERE NOT (make_id = 1 AND vds = 'PROMO'))"""

_DECODED = ("manuf_name", "vehicle_type", "make_name", "plant_name", "model_year", "model_name",
            "desc1", "desc2", "desc3", "desc4", "desc5", "engine", "drive_type", "transmission",
            "mpg")

DECODED = """
decoded AS (
  SELECT v.vin, manuf_name, vehicle_type, make_name, plant_name, model_year_name AS model_year, model_name,
         desc1, desc2, desc3, desc4, desc5, engine, drive_type, transmission, mpg
  FROM vehicles v
  JOIN manufacturers w ON left(v.vin, 3) = w.wmi
  JOIN makes m ON w.manuf_id = m.manuf_id
  JOIN plants p ON substr(v.vin, 11, 1) = p.plant_code AND m.make_id = p.make_id
  JOIN years y ON substr(v.vin, 10, 1) = y.model_year_code
  JOIN models d ON d.vds = substr(v.vin, 4, 5) AND d.make_id = m.make_id)"""

VINS = (VEHICLES, LOOKUPS, DECODED)

CATALOG = f"""
suits AS (
  SELECT p_brand AS color_or_style, replace(p_name, ' ', '_') || '.png' AS file_name, p_retailprice AS price
  FROM part),
files AS (SELECT DISTINCT file_name AS relative_path FROM suits),
sizes AS (SELECT DISTINCT lpad(CAST(p_size AS VARCHAR), 2, '0') AS sizes_available FROM part),
brand_codes AS (
  SELECT DISTINCT p_brand, CAST(substr(p_brand, 7, 2) AS INT) AS k, 'SWT_' || CAST(substr(p_brand, 7, 2) AS INT) AS code
  FROM part),
listed AS (SELECT suits.* FROM files JOIN suits ON relative_path = file_name),
website AS (
  SELECT c.color_or_style, c.price, c.file_name, c.size_list,
         coalesce('Consider: ' || headband || ' & ' || wristband, '{NO_ACCESSORY}') AS upsell_product_desc
  FROM (SELECT color_or_style, price, file_name, string_agg(sizes_available, ' | ' ORDER BY sizes_available) AS size_list
        FROM listed CROSS JOIN sizes GROUP BY color_or_style, price, file_name) c
  LEFT JOIN (SELECT p_brand, code FROM brand_codes WHERE k <= 18) u ON u.p_brand = c.color_or_style
  LEFT JOIN (SELECT code AS sc_code FROM brand_codes WHERE k <= 15) sc ON sc.sc_code = u.code
  LEFT JOIN (SELECT code AS l_code, 'Headband ' || k AS headband, 'Wristband ' || k AS wristband
             FROM brand_codes WHERE k <= 12) l ON l.l_code = sc.sc_code)"""

TRAIL = f"""
points AS (
  SELECT event_id AS point_id, 'trail_' || (event_id // {TRAIL_POINTS}) AS trail_name,
         CAST(-105.0::DOUBLE + (event_id % 20000) / 100000.0::DOUBLE AS DECIMAL(11,8)) AS lng,
         CAST(39.0::DOUBLE + value / 1000.0::DOUBLE AS DECIMAL(11,8)) AS lat
  FROM events),
pairs AS (SELECT *, lng || ' ' || lat AS coord_pair FROM points),
legs AS (
  SELECT *, lead(lng) OVER w AS next_lng, lead(lat) OVER w AS next_lat
  FROM points WINDOW w AS (PARTITION BY trail_name ORDER BY point_id)),
lengths AS (
  SELECT trail_name, coalesce(sum({haversine("lng::DOUBLE", "lat::DOUBLE", "next_lng::DOUBLE", "next_lat::DOUBLE")}), 0)
         AS trail_length, count(*) AS n_points
  FROM legs GROUP BY trail_name)"""

ORDER_TRAIL = f"""
order_points AS (
  SELECT o_orderkey // {TRAIL_POINTS} AS block, o_orderkey,
         CAST(-105.0::DOUBLE + (o_custkey % 20000) / 100000.0::DOUBLE AS DECIMAL(11,8)) AS lng,
         CAST(39.0::DOUBLE + (o_orderkey % 997) / 10000.0::DOUBLE AS DECIMAL(11,8)) AS lat
  FROM orders),
order_legs AS (
  SELECT *, lead(lng) OVER w AS next_lng, lead(lat) OVER w AS next_lat
  FROM order_points WINDOW w AS (PARTITION BY block ORDER BY o_orderkey)),
order_lengths AS (
  SELECT block, coalesce(sum({haversine("lng::DOUBLE", "lat::DOUBLE", "next_lng::DOUBLE", "next_lat::DOUBLE")}), 0)
         AS trail_length
  FROM order_legs GROUP BY block),
both_trails AS (
  SELECT 'orders_' || block AS feature_name, lng, lat FROM order_points
  UNION ALL SELECT trail_name, lng, lat FROM points),
both_lengths AS (
  SELECT 'orders_' || block AS feature_name, trail_length FROM order_lengths
  UNION ALL SELECT trail_name, trail_length FROM lengths)"""

PLACES = f"""
places AS (
  SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS amenity,
         c_mktsegment || ';' || c_nationkey AS cuisine,
         -105.0::DOUBLE + (c_custkey % 20000) / 100000.0::DOUBLE AS lng,
         39.7::DOUBLE + c_acctbal / 100000.0::DOUBLE AS lat
  FROM customer),
measured AS (
  SELECT *, {haversine("-104.97300245114094::DOUBLE", "39.76471253574085::DOUBLE", "lng", "lat")} AS metres FROM places)"""

POSTS = """
posts AS (
  SELECT item_id AS id, item_id % 7 AS user_id, '2024-01-01' AS created_at, string_split(text, ' ') AS tags
  FROM benchmark
  UNION ALL
  SELECT event_id, user_id, strftime(ts, '%Y-%m-%d'), CASE WHEN event_type <> 'error' THEN [event_type] END
  FROM events)"""

# --- the queries ------------------------------------------------------------

ORACLES: dict[str, str] = {
    # game logs
    "logs_enhanced": with_parts("SELECT * FROM enh", *ENHANCED),
    "ip_to_int": with_parts(f"SELECT ip_address, {ip_number('ip_address')} AS ip_int FROM logs", LOGS),
    "ip_lookup_one": with_parts(
        "SELECT start_ip, end_ip, start_ip_int, end_ip_int, city, region, country, timezone "
        "FROM loc WHERE 167970816 BETWEEN start_ip_int AND end_ip_int", LOC),
    "ip_range_join": with_parts("SELECT * FROM located", LOGS, LOC, LOCATED),
    "ip_range_join_keyed": with_parts("SELECT * FROM located", LOGS, LOC, LOCATED),
    "session_lengths": with_parts(
        "SELECT gamer_name, login, logout, game_session_length FROM sessions", *ENHANCED, SESSIONS),
    "session_heatgrid": with_parts(
        "SELECT session_length, tod_name, count(*) AS n_sessions FROM grid GROUP BY ALL", *ENHANCED, SESSIONS),
    "session_heatgrid_rows": with_parts("SELECT session_length, tod_name FROM grid", *ENHANCED, SESSIONS),
    "login_logout_rollup": with_parts(
        "SELECT gamer_name, string_agg(CAST(game_event_ltz AS VARCHAR), ' / ' ORDER BY game_event_ltz) "
        "AS login_and_logout FROM enh GROUP BY gamer_name", *ENHANCED),
    "time_of_day_lookup": with_parts(
        "SELECT CAST(tod.hour AS INT) AS hour, tod_name, count(*) AS n_events "
        "FROM events JOIN tod ON extract(hour FROM ts) = tod.hour GROUP BY ALL", TOD),
    "listagg_by_group": with_parts(
        "SELECT tod_name, string_agg(CAST(hour AS VARCHAR), ',' ORDER BY hour) AS hours "
        "FROM (SELECT DISTINCT tod.hour, tod_name FROM events JOIN tod ON extract(hour FROM ts) = tod.hour) "
        "GROUP BY tod_name", TOD),
    "merge_insert": with_parts(
        "SELECT CASE WHEN game_event_utc < TIMESTAMP '2024-01-15' THEN 'kept' ELSE ip_address END AS ip_address, "
        "* EXCLUDE (ip_address) FROM enh", *ENHANCED),
    "merge_update": with_parts(
        "SELECT CASE WHEN game_event_name = 'click' THEN 'set by merge' ELSE ip_address END "
        "AS ip_address, * EXCLUDE (ip_address) FROM enh", *ENHANCED),
    "delete_where": with_parts(
        "SELECT * FROM enh WHERE NOT (gamer_name = 'user_7')", *ENHANCED),
    "insert_select":
        "SELECT event_type AS user_event, CAST(user_id AS VARCHAR) AS user_login, ts AS datetime_iso8601 "
        "FROM events UNION ALL SELECT 'fake event', 'fake user', TIMESTAMP '2025-01-01 00:00:00'",
    "row_tallies": with_parts(
        "SELECT 'raw' AS stage, count(*) AS found, max(event_id) - min(event_id) + 1 AS expected FROM events "
        "UNION ALL SELECT 'logs', count(*), NULL FROM logs "
        "UNION ALL SELECT 'enhanced', count(*), NULL FROM enh", *ENHANCED),
    "max_case_tally":
        "SELECT max(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS tally "
        "FROM orders",
    # geography
    "nation_list": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "region_list": "SELECT r_regionkey, r_name FROM region",
    "region_nation":
        "SELECT r_name AS region, n_name AS nation FROM nation JOIN region ON n_regionkey = r_regionkey",
    "countries_per_region":
        "SELECT r_name AS region, count(n_name) AS num_countries FROM nation "
        "JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "distinct_segment": "SELECT DISTINCT c_mktsegment FROM customer",
    "segment_counts": "SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY c_mktsegment",
    "left_join_upper":
        "WITH iso AS (SELECT lower(n_name) AS iso_country_name, 'Official ' || n_name AS country_name_official, "
        "'C' || n_nationkey AS alpha_code_2digit FROM nation "
        "UNION ALL SELECT lower(s_name), 'Official ' || s_name, 'S' || s_nationkey FROM supplier) "
        "SELECT iso_country_name, country_name_official, alpha_code_2digit, r_name AS region FROM iso "
        "LEFT JOIN nation ON upper(iso_country_name) = n_name LEFT JOIN region ON n_regionkey = r_regionkey",
    # weather
    "and_or_precedence": with_parts("SELECT postal_code FROM codes", HISTORY),
    "filter_reduction": with_parts(
        "SELECT 'all' AS scope, count(*) AS n_rows FROM history UNION ALL "
        "SELECT 'mailing', count(*) FROM history JOIN codes USING (postal_code)", HISTORY),
    "semi_filter_count": with_parts("SELECT count(*) AS n_rows FROM history JOIN codes USING (postal_code)", HISTORY),
    "date_span": with_parts(
        "SELECT max(date_valid_std) AS last_day, min(date_valid_std) AS first_day "
        "FROM forecast JOIN codes USING (postal_code)", HISTORY, FORECAST),
    "avg_per_day": with_parts(
        "SELECT date_valid_std, round(avg(avg_cloud_cover_tot_pct), 6) AS avg_cloud_cover "
        "FROM forecast JOIN codes USING (postal_code) GROUP BY date_valid_std", HISTORY, FORECAST),
    # vehicles
    "vin_parse": with_parts(
        "SELECT vin, left(vin, 3) AS wmi, substr(vin, 4, 5) AS vds, substr(vin, 10, 1) AS model_year_code, "
        "substr(vin, 11, 1) AS plant_code FROM vehicles", VEHICLES),
    "vin_decode": with_parts("SELECT * FROM decoded", *VINS),
    "star_decode": with_parts(
        "SELECT make_name, model_year, count(*) AS n_vehicles FROM decoded GROUP BY ALL", *VINS),
    "implicit_join": with_parts(
        "SELECT DISTINCT v.vin, exterior, interior, manuf_name, make_name, model_year "
        "FROM vehicles v, decoded d WHERE d.vin = v.vin", *VINS),
    "update_from_join": with_parts(
        "SELECT v.vin, exterior, interior, CASE WHEN p_size > 40 THEN 'by hand model_name' END AS model_name, "
        + ", ".join(
            f"CASE WHEN p_size > 40 THEN 'by hand {c}' ELSE d.{c} END AS {c}" for c in _DECODED if c != "model_name"
        )
        + " FROM vehicles v LEFT JOIN (SELECT DISTINCT * FROM decoded) d ON v.vin = d.vin", *VINS),
    "load_by_name":
        "SELECT p_partkey AS fruit_id, p_name AS fruit_name, CAST(NULL AS VARCHAR) AS search_on, "
        "p_size AS shelf FROM part",
    # catalogue
    "product_name_clean":
        "SELECT p_name, array_to_string(list_transform(string_split(p_name, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ') AS product_name FROM part",
    "cross_join_sizes":
        "SELECT p_name, p_size FROM (SELECT DISTINCT p_name FROM part) CROSS JOIN (SELECT DISTINCT p_size FROM part)",
    "catalog_for_website": with_parts("SELECT * FROM website", CATALOG),
    "param_lookup": with_parts(
        "SELECT file_name, price, size_list, upsell_product_desc FROM website WHERE color_or_style = 'Brand#7'",
        CATALOG),
    "lateral_alias":
        "SELECT replace(p_name, ' ', '_') || '.png' AS relative_path, p_name || '.png' AS no_underscores_filename, "
        "p_name AS just_words_filename FROM part",
    "alias_in_where":
        "SELECT replace(p_name, ' ', '') AS squeezed FROM part WHERE replace(p_name, ' ', '') <> 'redwidget'",
    "like_ilike_in":
        "SELECT c_custkey, c_name FROM customer WHERE (c_mktsegment IN ('FURNITURE', 'BUILDING') "
        "AND (c_name ILIKE '%customer%7' OR c_name ILIKE '%13%')) OR c_mktsegment LIKE 'AUTO%' AND c_acctbal <= 0",
    # trails and places
    "parquet_project_cast":
        "SELECT event_id AS sequence_1, event_type AS trail_name, CAST(user_id AS VARCHAR) AS sequence_2, "
        "CAST(CAST(value AS DECIMAL(11,8)) AS VARCHAR) AS latitude FROM events",
    "coord_pair": with_parts(
        "SELECT point_id, coord_pair, 'POINT(' || coord_pair || ')' AS trail_point FROM pairs", TRAIL),
    "listagg_ordered": with_parts(
        "SELECT trail_name, string_agg(coord_pair, ',' ORDER BY point_id) AS coord_pairs FROM pairs "
        "GROUP BY trail_name", TRAIL),
    "linestring_build": with_parts(
        "SELECT trail_name, 'LINESTRING(' || string_agg(coord_pair, ',' ORDER BY point_id) || ')' AS my_linestring "
        "FROM pairs GROUP BY trail_name", TRAIL),
    "trail_length": with_parts(
        "SELECT trail_name, round(trail_length, 3) AS trail_length, n_points FROM lengths", TRAIL),
    "trail_bounds": with_parts(
        "SELECT feature_name, CAST(min(lng) AS DOUBLE) AS min_eastwest, CAST(max(lng) AS DOUBLE) AS max_eastwest, "
        "CAST(min(lat) AS DOUBLE) AS min_northsouth, CAST(max(lat) AS DOUBLE) AS max_northsouth, "
        "any_value(round(trail_length, 3)) AS trail_length FROM both_trails JOIN both_lengths USING (feature_name) "
        "GROUP BY feature_name", TRAIL, ORDER_TRAIL),
    "union_all_sources": with_parts(
        "SELECT 'orders_' || block AS feature_name, 'LINESTRING(' || "
        "string_agg(lng::DOUBLE || ' ' || lat::DOUBLE, ',' ORDER BY o_orderkey) || ')' AS wkt "
        "FROM order_points GROUP BY block UNION ALL "
        "SELECT trail_name, 'LINESTRING(' || string_agg(lng::DOUBLE || ' ' || lat::DOUBLE, ',' ORDER BY point_id) "
        "|| ')' FROM points GROUP BY trail_name", TRAIL, ORDER_TRAIL),
    "bbox_polygon": with_parts(
        "SELECT 'POLYGON((' || w || ' ' || n || ',' || e || ' ' || n || ',' || e || ' ' || s || ',' || w || ' ' || s "
        "|| '))' AS my_polygon FROM (SELECT CAST(min(lng) AS DOUBLE) AS w, CAST(max(lng) AS DOUBLE) AS e, "
        "CAST(min(lat) AS DOUBLE) AS s, CAST(max(lat) AS DOUBLE) AS n FROM both_trails)", TRAIL, ORDER_TRAIL),
    "geo_distance": with_parts(
        "SELECT point_id, round("
        + haversine("-104.97300245114094::DOUBLE", "39.76471253574085::DOUBLE", "lng::DOUBLE", "lat::DOUBLE")
        + ", 3) AS distance FROM points", TRAIL),
    "geo_wkt": with_parts("SELECT place_id, 'POINT(' || lng || ' ' || lat || ')' AS wkt FROM places", PLACES),
    "nearest_places": with_parts(
        "SELECT place_id, name, cuisine, round(metres, 3) AS metres FROM measured WHERE "
        "((amenity IN ('FURNITURE', 'BUILDING')) AND (name ILIKE '%customer%7' OR name ILIKE '%13%')) "
        "OR (cuisine LIKE '%HOUSE%;1%' OR cuisine LIKE 'MACH%;2')", PLACES),
    # variants
    "json_path_extract":
        "SELECT 'e' || event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
        "json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.nothing') AS missing, "
        "event_type AS first_tag FROM events",
    "json_filter_present": with_parts("SELECT tags[1] AS first_hashtag FROM posts WHERE tags[1] IS NOT NULL", POSTS),
    "flatten_array": with_parts(
        "SELECT user_id, id AS tweet_id, unnest(tags) AS hashtag_text FROM posts", POSTS),
    "flatten_positions":
        "SELECT vec_id, unnest(range(len(embedding))) AS position, "
        "CAST(CAST(unnest(embedding) AS VARCHAR) AS DOUBLE) AS component FROM embeddings",
    # tables
    "load_transform":
        "SELECT p_partkey AS fruit_id, p_name AS fruit_name FROM part "
        "UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "ctas_top_n":
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "update_where":
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderpriority END AS o_orderpriority, "
        "CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders",
    "snapshot_copy": "SELECT * FROM customer",
    "schema_evolve":
        "SELECT c_custkey AS customer_id, c_name, false AS order_filled FROM customer",
    "unique_check": "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    "number_rows":
        "SELECT count(*) AS n_rows, min(n) AS first_key, max(n) AS last_key, count(DISTINCT n) AS n_keys "
        "FROM (SELECT row_number() OVER () AS n FROM lineitem)",
    "udf_sum3":
        "SELECT p_partkey, CAST(CAST(p_partkey AS DECIMAL(18,4)) + p_size + CAST(p_retailprice AS DECIMAL(18,4)) "
        "AS DOUBLE) AS total FROM part",
    # files
    "two_header_rows": "SELECT p_partkey AS fruit_id, p_name AS fruit_name FROM part",
    "caret_records": "SELECT 'C' || c_custkey AS product_code, c_mktsegment AS has_matching FROM customer",
    "comma_file": "SELECT c_custkey AS id, c_name || ', x' AS name FROM customer",
    "tab_file": "SELECT p_partkey AS id, p_name AS name FROM part",
    "semicolon_records": "SELECT s_suppkey AS key, s_name AS name FROM supplier",
    "json_lines":
        "SELECT event_type, count(*) FILTER (event_id % 10 <> 3) AS n_read, "
        "count(*) FILTER (event_id % 10 = 3) AS n_rejected FROM events GROUP BY event_type",
    "append_then_truncate":
        "SELECT count(*) AS n_rows, 'appended' AS step FROM orders UNION ALL SELECT 0, 'truncated'",
    "column_defaults":
        "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, "
        "false AS order_filled FROM orders",
    "next_in_cut_groups":
        "SELECT event_type, event_id AS at, lead(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS next_at "
        "FROM events WHERE event_id % 50 <> 0",
    "quoted_carriage_returns": "SELECT s_suppkey AS key, s_name || '|x' AS name FROM supplier",
    "bad_records":
        "SELECT event_id AS id, event_id || ',n/a' AS bad_record FROM events WHERE event_type = 'error'",
    "file_rows":
        "SELECT min(event_id) AS first_key, count(*) AS n_rows, count(*) AS last_row, count(*) AS n_numbers "
        f"FROM events GROUP BY event_id // {_width('events', 'event_id')}",
    "files_and_rows":
        f"SELECT count(DISTINCT o_orderkey // {_width('orders', 'o_orderkey')}) AS n_files, count(*) AS n_rows, true AS has_content "
        "FROM orders",
    "json_arrays":
        "SELECT c_custkey, c_name, true AS json_null, "
        f"row_number() OVER (PARTITION BY c_custkey // {_width('customer', 'c_custkey')} ORDER BY c_custkey) AS file_row FROM customer",
    "json_elements":
        "SELECT o_orderkey, '},[{\"' || o_orderpriority || '\\\",]\\' AS note, o_custkey, "
        f"row_number() OVER (PARTITION BY o_orderkey // {_width('orders', 'o_orderkey')} ORDER BY o_orderkey) AS file_row FROM orders",
    "quoted_line_breaks":
        "SELECT c_custkey AS id, c_name || chr(10) || 'said \"' || c_mktsegment || '\",' || chr(10) || chr(10) AS name FROM customer",
    "incremental_load": with_parts("SELECT * FROM enh", *ENHANCED),
    **STORED,
}
