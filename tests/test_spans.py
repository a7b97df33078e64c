"""Files cut into byte ranges inside quotes and arrays give the rows of the one-task readers."""

from __future__ import annotations

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

import lakeworks.sources.spans as spans_module
from lakeworks.sources import documents, formats
from lakeworks.sources.spans import spans, switches


@pytest.fixture(params=[211])
def ranges(spark, request):
    """Byte ranges of so many bytes, far smaller than the files."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "0")
    yield request.param
    for name, value in old.items():
        spark.conf.set(name, value)


def a_value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind == 0:
        return rng.choice([None, True, 3, -2.5, 10**12])
    if kind < 6:
        return "".join(rng.choice('ab,"\\[]{}:\n é') for _ in range(rng.randrange(25)))
    if kind < 8:
        return {f"k{k},\"": a_value(rng, depth + 1) for k in range(rng.randrange(4))}
    return [a_value(rng, depth + 1) for _ in range(rng.randrange(4))]


def as_rows(frame):
    rows = frame.select("file_name", "file_row", F.to_json("raw").alias("raw")).collect()
    return sorted((r["file_name"], r["file_row"], json.dumps(json.loads(r["raw"]), sort_keys=True)) for r in rows)


def test_array_files(spark, ranges, tmp_path):
    rng = random.Random(ranges)
    want = []
    for k, indent in enumerate([None, 1, None, 3]):
        values = [a_value(rng) for _ in range(25)]
        lead = ["", "\n \t\n", "\ufeff", "\r\n"][k]
        (tmp_path / f"f{k}.json").write_text(lead + json.dumps(values, indent=indent, ensure_ascii=k % 2 == 0) + "\n" * k)
        want += [(f"f{k}.json", n + 1, json.dumps(v, sort_keys=True)) for n, v in enumerate(values)]
    (tmp_path / "empty.json").write_text("[ \n ]")
    (tmp_path / "numbers.json").write_text(json.dumps(list(range(300))))
    want += [("numbers.json", n + 1, str(n)) for n in range(300)]
    cut = documents.read_json_array(spark, str(tmp_path), numbered=True, whole_file_bytes=0)
    assert as_rows(cut) == sorted(want)
    # both ways of reading agree, and so does a mix of them
    assert as_rows(documents.read_json_array(spark, str(tmp_path), numbered=True)) == sorted(want)
    assert as_rows(documents.read_json_array(spark, str(tmp_path), numbered=True, whole_file_bytes=3000)) == sorted(want)


def test_one_array_is_read_by_many_tasks(spark, ranges, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"a": k, "t": "x,]" * (k % 9)} for k in range(200)]))
    pieces = spark.read.option("lineSep", ",").text(str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 10
    found = documents.json_spans(pieces)
    assert sorted(r["number"] for r in found.select("number").collect()) == list(range(200))


def test_large_files_of_other_kinds(spark, ranges, tmp_path):
    lines = [{"a": k, "b": "x,y"} for k in range(50)]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(x) for x in lines))
    rows = documents.read_json_array(spark, str(tmp_path), whole_file_bytes=0)
    assert sorted(json.loads(r[0])["a"] for r in rows.select(F.to_json("raw")).collect()) == list(range(50))


def test_broken_large_files(spark, ranges, tmp_path):
    good = json.dumps([{"a": 1}] * 40)
    (tmp_path / "good.json").write_text(good)
    for name, text in {"open": good[:-1], "quote": good[:-4] + '"}]', "comma": good.replace("}, {", "}, , {", 1), "line": "{]\n" * 40}.items():
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(Exception):
            documents.read_json_array(spark, str(tmp_path / f"{name}.json"), whole_file_bytes=0).collect()
    kept = documents.read_json_array(spark, str(tmp_path), numbered=True, on_error="skip", whole_file_bytes=0)
    assert {(r["file_name"], r["n"]) for r in kept.groupBy("file_name").agg(F.count("*").alias("n")).collect()} == {("good.json", 40)}


@pytest.mark.parametrize("record", [None, "\r"])
def test_line_breaks_in_quotes(spark, ranges, tmp_path, record):
    rng = random.Random(7)
    end = record or "\n"
    rows = [(k, "".join(rng.choice(["a", "|", ",", '"', end, "é"]) for _ in range(rng.randrange(30)))) for k in range(150)]
    for n in range(3):
        with open(tmp_path / f"f{n}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["id", 'na"me' + end])
            writer.writerows(rows[n * 50 : n * 50 + 50])
    fmt = formats.Format(sep=",", record=record, quote='"', header_rows=1, breaks_in_quotes=True)
    read = formats.read_delimited(spark, str(tmp_path), fmt, "id bigint, name string")
    assert {(r["id"], r["name"] or "") for r in read.collect()} == set(rows)
    if record is None:
        plain = spark.read.schema("id bigint, name string").options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
        assert sorted((r["id"], r["name"] or "") for r in plain.collect()) == sorted(rows)


def test_bad_records_across_lines(spark, ranges, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\nno,"p\nq"\n2,"z"\n' * 20)
    fmt = formats.Format(sep=",", quote='"', breaks_in_quotes=True)
    bad = formats.read_delimited(spark, str(tmp_path), fmt, "id bigint, name string", on_error="report")
    assert [r[formats.BAD_RECORD] for r in bad.collect()] == ['no,"p\nq"'] * 20
    with pytest.raises(Exception):
        formats.read_delimited(spark, str(tmp_path), fmt, "id bigint, name string", on_error="abort").collect()
    with pytest.raises(ValueError):
        formats.read_delimited(spark, str(tmp_path), fmt)


def test_other_ranges_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n' * 400)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    found = spans(lines, "\n", switches(F.col("value")))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        with pytest.raises(Exception, match="other pieces"):
            found.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_files_with_content(spark, ranges, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert spans(spark.read.text(str(tmp_path)), "\n", switches(F.col("value"))).count() == 0


def test_a_range_is_taken_in_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spans_module, "STRETCH_BITS", 3)
    # pieces of records, quotes and depths that cross stretches of eight pieces
    whole = {
        "a.json": [{"k": n, "note": '},[{"\\",]' * (n % 5), "keys": list(range(n % 23))} for n in range(120)],
        "b.json": [[n, "x,y" * (n % 11)] for n in range(70)],
    }
    for name, values in whole.items():
        (tmp_path / name).write_text("\n " + json.dumps(values))
    rows = documents.read_json_array(spark, str(tmp_path), numbered=True, whole_file_bytes=0)
    found = rows.select("file_name", "file_row", F.to_json("raw").alias("raw")).collect()
    got = {(r["file_name"], r["file_row"]): json.loads(r["raw"]) for r in found}
    assert len(found) == len(got) == 190
    assert got == {(name, k + 1): v for name, values in whole.items() for k, v in enumerate(values)}
    # the windows hold a stretch, and no row that is ordered carries its file's name
    windows = [w for w in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in w]
    assert windows and all("_stretch" in w and "file_path" not in w for w in windows)
