from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import storage
from lakeworks.plans import geography, library, trails
from lakeworks.schemas import struct
from lakeworks.sources import documents, files, formats, tables


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_comma_with_optional_quotes(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'Name Of It,Depth\n"Beans, dry" , 4\nPeas,"5"\n"say ""hi""",6\n')
    df = formats.read_delimited(spark, path, formats.COMMA_QUOTED)
    assert df.columns == ["Name Of It", "Depth"]
    assert rows(df) == [("Beans, dry", "4"), ("Peas", "5"), ('say "hi"', "6")]


def test_pipe_keeps_commas_repeats_and_last_line(spark, tmp_path):
    path = put(tmp_path, "p.txt", "Name|Soil\nPeas, green|1\nKale|2\nKale|2")
    df = formats.read_delimited(spark, path, formats.PIPE, struct(name="string", soil="int"))
    assert rows(df) == [("Peas, green", 1), ("Kale", 2), ("Kale", 2)]


def test_tab_is_trimmed(spark, tmp_path):
    path = put(tmp_path, "t.tsv", "ID\tKIND\tTEXT\n1 \tAny\tSome of it      .\n2\tClay\tDoesn’t roll   \n")
    df = formats.read_delimited(spark, path, formats.TAB, struct(id="int", kind="string", text="string"))
    assert rows(df) == [(1, "Any", "Some of it      ."), (2, "Clay", "Doesn’t roll")]


def test_record_delimiters(spark, tmp_path):
    caret = put(tmp_path, "c.txt", "\r\nA=yes^\r\nB=no^\r\nC=^\r\n")
    df = formats.read_delimited(spark, caret, formats.EQUALS_CARET, struct(code="string", flag="string"))
    code = formats.without_line_breaks(F.col("code"))
    assert rows(df.select(code, "flag").filter("code <> ''")) == [("A", "yes"), ("B", "no"), ("C", None)]
    semi = put(tmp_path, "s.txt", "S;\r\nM ;\r\nL;\r\n;")
    sizes = formats.read_delimited(spark, semi, formats.SEMICOLON_RECORDS, struct(size="string"))
    assert [r[0] for r in rows(sizes) if r[0]] == ["S", "M", "L"]
    both = put(tmp_path, "b.txt", "A|x|y;\r\nB|z|w;")
    lines = formats.read_delimited(spark, both, formats.PIPE_SEMICOLON, struct(a="string", b="string", c="string"))
    assert rows(lines.select(formats.without_line_breaks(F.col("a")), "b", "c")) == [("A", "x", "y"), ("B", "z", "w")]
    assert rows(formats.read_lines(spark, semi, ";"))[0] == ("S",)


def test_two_header_rows_of_every_file(spark, tmp_path):
    put(tmp_path, "f/1.txt", "THE FRUITS\nname % id\nFig % 1\n Kiwi%2\n")
    put(tmp_path, "f/2.txt", "THE FRUITS\nname % id\nLime%3\n")
    df = formats.read_positional(
        spark, str(tmp_path / "f"), formats.PERCENT_TWO_HEADERS, {"fruit_id": 2, "fruit_name": 1}, width=2
    )
    assert sorted(rows(df)) == [("1", "Fig"), ("2", "Kiwi"), ("3", "Lime")]


def test_load_by_name(spark, tmp_path):
    path = put(tmp_path, "lot.csv", "Interior,VIN,Unknown\nblack,X1,9\n")
    df = formats.read_by_name(spark, path, struct(vin="string", exterior="string", interior="string"))
    assert rows(df) == [("X1", None, "black")]


def test_error_policies(spark, tmp_path):
    path = put(tmp_path, "bad.csv", "id,n\n1,5\n2,x\n3,7,9\n4\n")
    schema = struct(id="int", n="int")
    report = formats.read_delimited(spark, path, formats.COMMA, schema, on_error="report")
    assert sorted(rows(report.select("bad_record"))) == [("2,x",), ("3,7,9",), ("4",)]
    assert formats.read_delimited(spark, path, formats.COMMA, schema).count() == 4
    with pytest.raises(Exception, match="MALFORMED"):
        formats.read_delimited(spark, path, formats.COMMA, schema, on_error="abort").select("id").collect()


def test_json_documents(spark, tmp_path):
    array = put(tmp_path, "j/a.json", '[{"AUTHOR_UID":1,"FIRST_NAME":"A","MIDDLE_NAME":null},\n{"AUTHOR_UID":2}]')
    df = documents.read_json_array(spark, array, "raw_author")
    assert sorted(rows(library.authors(df))) == [(1, "A", None, None), (2, None, None, None)]
    numbered = documents.read_json_array(spark, str(tmp_path / "j"), numbered=True)
    assert sorted(rows(numbered.select("file_name", "file_row"))) == [("a.json", 1), ("a.json", 2)]
    one = put(tmp_path, "o.json", '{"a":\n1}')
    assert documents.read_json_array(spark, one).count() == 1
    mixed = put(tmp_path, "m.json", '{"a":\n"}{"}\n\n{"a":[\n[1]]}\r\n[3,[4]]')
    assert [str(r[0]) for r in rows(documents.read_json_array(spark, mixed))] == ['{"a":"}{"}', '{"a":[[1]]}', "3", "[4]"]
    broken = put(tmp_path, "x.json", '{"a":1} {"a":2}')
    assert documents.read_json_array(spark, broken, on_error="skip").count() == 0
    with pytest.raises(Exception, match="MALFORMED"):
        documents.read_json_array(spark, broken).collect()
    assert documents.read_json_array(spark, put(tmp_path, "e.json", "")).count() == 0
    lines = put(tmp_path, "l.json", '{"a":1}\n{"a":2}\n')
    assert documents.read_json_lines(spark, lines).count() == 2


def test_books_and_posts(spark, tmp_path):
    books = put(tmp_path, "b.json", '[{"authors":[{"first_name":"F","last_name":"M"},{"first_name":"G"}]},{"authors":[]}]')
    raw = documents.read_json_array(spark, books, "raw_nested_book")
    assert sorted(rows(library.book_authors(raw)), key=str) == [("F", "M"), ("G", None)]
    post = '[{"id":5,"user":{"id":6},"created_at":"2024-01-02","entities":{"hashtags":[{"text":"x"},{"text":"y"}]}},{"id":7,"created_at":"2024-01-01"}]'
    posts = documents.read_json_array(spark, put(tmp_path, "t.json", post), "raw_status")
    assert sorted(rows(library.hashtags_normalized(posts))) == [(6, 5, "x"), (6, 5, "y")]
    assert rows(library.with_hashtags(posts)) == [("x",)]
    assert [str(r[0]) for r in rows(library.creation_dates(posts))] == ["2024-01-01", "2024-01-02"]


def test_geojson_file(spark, tmp_path):
    doc = '{"crs":{"properties":{"name":"C"}},"features":[{"properties":{"Name":"T"},"geometry":{"type":"LineString","coordinates":[[1.5,2.0],[1.5,3.0]]}}]}'
    df = documents.read_json_document(spark, put(tmp_path, "g.json", doc))
    row = trails.trails_from_documents(df).first()
    assert (row["feature_name"], row["specs"]) == ("T", "C") and row["trail_length"] == pytest.approx(111195, abs=5)
    bounds = trails.boundaries(trails.all_trails(trails.trails_from_documents(df)))
    assert tuple(bounds.first())[2:6] == (1.5, 1.5, 2.0, 3.0)
    assert trails.bounding_polygon(bounds, closed=True).first()[0].count(",") == 4


def test_row_numbers_across_file_pieces(spark, tmp_path):
    put(tmp_path, "n/a.txt", "".join(f"{i}\n" for i in range(1, 4001)))
    put(tmp_path, "n/b.txt", "".join(f"{i}\n" for i in range(1, 901)))
    put(tmp_path, "n/empty.txt", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = formats.read_lines(spark, str(tmp_path / "n"))
        assert lines.rdd.getNumPartitions() > 8
        got = files.with_row_numbers(lines)
        assert got.filter(F.col("value").cast("bigint") == F.col("file_row")).count() == 4900
        assert got.count() == 4900
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    put(tmp_path, "n/deep/a.txt", "1\n")
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "n"))
    counted = sorted((r["file_name"], r["n_rows"]) for r in files.rows_per_file(lines).collect())
    assert counted == [("a.txt", 1), ("a.txt", 4000), ("b.txt", 900)]
    listed = files.list_files(spark, str(tmp_path / "n")).join(files.rows_per_file(lines), "file_url")
    assert {r["relative_path"]: r["n_rows"] for r in listed.collect()}["deep/a.txt"] == 1


def test_file_listing(spark, tmp_path):
    put(tmp_path, "pics/red suit.png", "x")
    put(tmp_path, "pics/deep/blue.png", "xy")
    put(tmp_path, "pics/note.txt", "n")
    listing = files.list_files(spark, str(tmp_path / "pics"), "*.png")
    assert sorted((r["relative_path"], r["size"]) for r in listing.collect()) == [("deep/blue.png", 2), ("red suit.png", 1)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_parquet_tables(spark, tmp_path):
    path = str(tmp_path / "pq")
    spark.range(3).withColumn("lat", F.lit("39.123456789")).coalesce(1).write.parquet(path)
    df = tables.project_cast(spark.read.parquet(path), {"point_id": ("id", "bigint"), "lat": ("lat", "decimal(11,8)")})
    assert str(df.first()["lat"]) == "39.12345679"
    external = tables.external_table(spark, "ext_points", path)
    assert external.filter(F.col("my_filename").endswith(".parquet")).count() == 3
    assert files.with_file_name(spark.read.parquet(path)).select("file_name").distinct().count() == 1


def test_named_files_and_stored_distances(spark, tmp_path):
    paths = [put(tmp_path, f"w/{n}.csv", f"id\n{n}\n") for n in (1, 2, 3)]
    df = formats.read_delimited(spark, paths[:2], formats.COMMA, struct(id="int"))
    assert sorted(rows(df)) == [(1,), (2,)]
    raw = spark.createDataFrame([(1, "t", -105.0, 39.123456789)], "sequence_1 int, trail_name string, latitude double, longitude double")
    table = str(tmp_path / "stored")
    storage.publish(trails.with_distance(trails.trail_points(raw), -105.0, 39.12345679, "metres"), table)
    row = storage.read(spark, table).first()
    assert (row["coord_pair"], round(row["metres"], 6)) == ("-105.00000000 39.12345679", 0)
    points = trails.trail_points(raw)
    assert trails.points_wkt(points).first()["trail_point"] == "POINT(-105.00000000 39.12345679)"
    assert tuple(trails.trail_lengths(points).first()) == ("t", 0.0, 1)


def test_currency_view(spark):
    df = spark.createDataFrame([("AD", "EUR", 1)], "country_char_code string, currency_char_code string, x int")
    assert rows(geography.simple_currency(df)) == [("AD", "EUR")]


def test_array_file_above_the_variant_limit_is_read_whole(spark, tmp_path):
    """140 MB in one array; the limit of 128 MiB holds for an element, not for the file."""
    path, n = tmp_path / "big.json", 700_000
    with path.open("w") as out:
        out.write("[")
        for k in range(n):
            out.write(("," if k else "") + f'{{"id":{k},"text":"{"x" * 180}"}}')
        out.write("]")
    assert path.stat().st_size > 128 << 20
    ids = documents.read_json_array(spark, str(path)).select(F.variant_get("raw", "$.id", "bigint").alias("id"))
    assert tuple(ids.agg(F.count("id"), F.sum("id")).first()) == (n, n * (n - 1) // 2)


def test_bad_lines_cost_only_themselves(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"a": 1}\n{"a": \n\n[2]\nnull\n')
    good, bad = documents.split_json_lines(spark.read.text(str(path)))
    assert sorted(str(r["raw"]) for r in good.collect()) == ["[2]", "null", '{"a":1}']
    assert [r["line"] for r in bad.collect()] == ['{"a":']
