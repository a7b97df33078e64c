"""Language and quality: accuracy on held-out documents, and odd rows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeworks.llm import language, quality
from lakeworks.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_language_of_held_out_documents(spark, docs):
    found = QUERIES["op7_language_id"](spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == docs.count()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_language_of_odd_rows(docs_of, docs):
    model = language.fit(docs)
    texts = [None, "", "123 !?", "the and of with", "the and of with", "der die und nicht " * 2000]
    found = {r.doc_id: r for r in language.detect(docs_of(texts), model).collect()}
    assert [found[k].lang_pred for k in range(3)] == ["und"] * 3
    assert not any(found[k].accepted for k in range(3))
    assert found[3].lang_pred == found[4].lang_pred == "en" and found[5].lang_pred == "de"
    assert found[5].n_chars == len(texts[5]) and found[5].accepted
    nothing = language.fit(docs_of(["x"]).withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in language.detect(docs_of(["some text"]), nothing).collect()] == ["und"]
    assert language.detect(docs_of(["x"]).limit(0), model).count() == 0


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op4_quality_classifier"](spark, FOLDER).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    above = sum((good > b).sum() + (good == b).sum() / 2 for b in bad) / (len(good) * len(bad))
    assert above > 0.93
    assert (held.predicted == held.quality).mean() > 0.93


def test_quality_of_odd_rows(spark, docs_of, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    odd = labels.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, quality int"))
    model = quality.fit(docs, odd)
    found = quality.score(docs_of([None, "", "word " * 50_000, "x", "x"]), model).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert len({r.score for r in found if r.text in (None, "")}) == 1
    for one_class, share in ((labels.filter("quality = 1"), 1.0), (labels.limit(0), 0.5)):
        scores = {r.score for r in quality.score(docs_of(["a", None]), quality.fit(docs, one_class)).collect()}
        assert scores == {share}


def test_languages_are_judged_without_pandas(docs_of):
    from pyspark.util import PythonEvalType

    docs = docs_of(["the cat sat", None, "", "12", "der hund und die katze"])
    found = language.detect(docs, language.LanguageModel({"en": b"the cat sat on the mat", "de": b"der hund und die katze"}))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    evaluated = [line for line in plan.splitlines() if "EvalPython" in line]
    # pandas would stay in the workers of all later stages
    assert evaluated and all(line.endswith(f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}") for line in evaluated)
    got = {r["text"]: (r["lang_pred"], r["score"] > 0) for r in found.collect()}
    assert got == {"the cat sat": ("en", True), None: ("und", False), "": ("und", False), "12": ("und", False), "der hund und die katze": ("de", True)}
    assert language.detect(docs.limit(0), language.LanguageModel({"en": b"the"})).count() == 0
