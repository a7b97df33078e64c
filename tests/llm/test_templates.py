"""Template decontamination: whole, cut and re-parameterised items, and texts that only look alike."""

from __future__ import annotations

import os

import duckdb
import pytest

from lakeworks.llm import templates
from lakeworks.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ITEM = "question: a train carries 12 boxes from Paris to Lyon in 3 hours and Anna counts 12 boxes again before lunch today"


@pytest.fixture
def items(spark):
    rows = [(1, ITEM), (2, None), (3, ""), (4, "what is 5 plus 3"), (None, "an item that has no number of its own at all")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_slots(docs_of, items):
    other = ITEM.replace("12", "77").replace("Paris", "Rome").replace("Anna", "Bob").replace("hours", "days").replace("3", "9")
    texts = [
        ITEM,
        "Before it. " + other + " and after",
        ITEM.replace("12 boxes from", "77 boxes from"),  # one value for two different ones
        " ".join(ITEM.split()[:11]),
        " ".join(ITEM.split()[:9]),
        "what is 8 plus 1",
        None,
        "",
        "1 2 3 4 5 6 7 8 9 10 11 12 13",
        "this is an item that has no number of its own at all, is it",
        "nothing of the kind",
    ]
    found = {(r.doc_id, r.item_id): r for r in templates.matches(docs_of(texts), items).collect()}
    assert {k for k in found if k[1] == 1} == {(0, 1), (1, 1), (3, 1)}
    assert found[1, 1].coverage == 1.0 and found[1, 1].n_slots == found[0, 1].n_slots > 3
    assert (5, 4) in found and (9, None) in found
    assert {k[0] for k in found} == {0, 1, 3, 5, 9}


def test_removal_and_odd_rows(docs_of, items):
    docs = docs_of([(7, ITEM), (7, ITEM), (7, "clean text that stays"), (None, ITEM), (None, None)])
    found = templates.matches(docs, items)
    left = templates.without_matches(docs, found)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(7, "clean text that stays"), (None, None)], key=str)
    assert templates.matches(docs.limit(0), items).count() == templates.matches(docs, items.limit(0)).count() == 0


def test_without_the_filter_the_join_finds_the_same(docs_of, items, monkeypatch):
    docs = docs_of([ITEM, "x " + ITEM])
    one = sorted(map(tuple, templates.matches(docs, items).collect()))
    monkeypatch.setattr(templates, "FILTER_WINDOWS", 0)
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, templates.matches(docs, items).collect())) == one


def test_few_literal_words_match_verbatim(spark, docs_of):
    table = "3 14 15 92 65 35 89 79 32 38 46 26"
    people = "Anna Bob Carla Dora Emil Fritz Greta Hans Ida Jonas"
    mixed = "the sum of all the parts we know is 4 8 15 16 23 42 Locke Hurley Sawyer Kate Jack"
    items = spark.createDataFrame([(1, table), (2, people), (3, mixed), (4, "10 20 30 40 50")], "item_id long, text string")
    texts = [
        table,
        f"so many figures as {table.replace(' ', ', ')} in it",
        f"a list of {people} and others",
        people.replace("Dora", "Dirk"),  # too few windows without the other name
        " ".join(str(n) for n in range(50, 62)),  # placeholders alone
        " ".join(mixed.split()[9:]),
        mixed.replace("4 8 15 16 23 42", "1 2 3 4 5 6"),
        "it counts 10 20 30 40 50 and on",
        "it counts 10 20 30 40 60 and on",
    ]
    found = {(r.doc_id, r.item_id): r for r in templates.matches(docs_of(texts), items).collect()}
    assert set(found) == {(0, 1), (1, 1), (2, 2), (5, 3), (6, 3), (7, 4)}
    assert found[0, 1].coverage == found[1, 1].coverage == found[2, 2].coverage == 1.0
    assert found[0, 1].n_windows == 5 and found[0, 1].n_slots == 0
    kept = templates.without_matches(docs_of(texts), templates.matches(docs_of(texts), items))
    assert {r.doc_id for r in kept.collect()} == {3, 4, 8}


def test_one_inconsistent_value_leaves_the_windows_without_slots(spark, docs_of):
    prose = " ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(100))
    item = f"there are 12 boxes {prose} and again 12 boxes"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [item, item.replace("12", "77"), item.replace("again 12", "again 13"), "all 12 boxes and again 13 boxes"]
    found = {r.doc_id: r for r in templates.matches(docs_of(texts), items).collect()}
    assert set(found) == {0, 1, 2}
    assert found[0].coverage == found[1].coverage == 1.0
    # 108 words have 101 windows; 3 hold the first number and 2 the second
    assert found[2].n_windows == 101 - 3 - 2 and found[2].n_slots == 0 and 0.9 < found[2].coverage < 1


def test_items_of_a_few_words_match_whole_lines(spark, docs_of):
    items = spark.createDataFrame([(1, "yes"), (2, "what is this"), (3, "42"), (4, "what is this thing")], "item_id long, text string")
    texts = [
        "yes",
        "well yes and no, but what is this, 42 or more",
        "first line\nWhat is this?\n\n42",
        "Yes.\nand what is this",
        "ask what is this thing here",
        "42",
    ]
    docs = docs_of(texts)
    found = templates.matches(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(0, 1), (2, 2), (2, 3), (3, 1), (4, 4), (5, 3)}
    assert [r.doc_id for r in templates.without_matches(docs, found).collect()] == [1]


def test_finds_every_item_written_out(spark):
    found = {(r.doc_id, r.item_id) for r in QUERIES["op6_template_decontamination"](spark, FOLDER).collect()}
    want = duckdb.sql(
        f"SELECT doc_id, item_id FROM '{FOLDER}/documents.parquet' d JOIN '{FOLDER}/benchmark.parquet' b ON contains(d.text, b.text)"
    ).fetchall()
    assert set(want) <= found
    assert len(found) <= len(want) + 3
