"""The stages on the small tables, each against what a plain program makes of its input."""

from __future__ import annotations

import os
import re

import pytest
from test_minhash import groups
from test_secrets import spans

import corpus_pipeline
from lakeworks.llm import language, secret_scan

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").replace("sf0.01", "sf0.001")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs.collect()}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
    return out


def test_stages_keep_the_columns(results):
    columns = results["documents"][0].asDict().keys()
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert results[name][0].asDict().keys() == columns


def test_language(spark, results):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs)
    coders = language.compressors(model.dictionaries, model.level)
    judged = {r.doc_id: language._judge(r.text, coders) for r in results["documents"]}
    kept = {r.doc_id for r in results["language_id"]}
    assert kept == {i for i, (name, _, margin) in judged.items() if name != "und" and margin >= language.LEAST_MARGIN}
    assert len(kept) >= 0.97 * len(judged)


def test_near_duplicates(results):
    found = groups([(r.doc_id, r.text) for r in results["language_id"]], 5)
    assert {r.doc_id for r in results["near_dedup"]} == {i for i, (_, least) in found.items() if i == least}


def test_benchmark(spark, results):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in results["near_dedup"] if any(item in r.text for item in items)}
    gone = {r.doc_id for r in results["near_dedup"]} - {r.doc_id for r in results["decontamination"]}
    assert leaked <= gone

    def grams(text):
        listed = [w.strip(".,;:!?") for w in text.lower().split()]
        return {tuple(listed[k : k + 8]) for k in range(len(listed) - 7)}

    known = set().union(*map(grams, items))
    assert all(grams(r.text) & known for r in results["near_dedup"] if r.doc_id in gone)


def test_secrets(results):
    before = {r.doc_id: r for r in results["decontamination"]}
    assert before.keys() == {r.doc_id for r in results["secret_scan"]}
    for r in results["secret_scan"]:
        found = spans(before[r.doc_id].text)
        if not found:
            assert r == before[r.doc_id]
            continue
        assert r.n_chars == len(r.text) and secret_scan.MASK in r.text
        assert not any(before[r.doc_id].text[a:b] in r.text for a, _, _, b in found)


def test_packing(results):
    assert {r.doc_id for r in results["packing"]} == {r.doc_id for r in results["secret_scan"]}
    filled: dict[int, int] = {}
    for r in results["packing"]:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 1024
    assert len(filled) <= -(-sum(filled.values()) // 1024) + 2


def test_run_gives_the_same(spark, results):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    pieces = lambda rows: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert pieces(found) == pieces(results["packing"])


def test_operators_do_not_hide_missing_imports():
    for path in (corpus_pipeline.__file__,):
        assert not re.search(r"except\s+(ImportError|ModuleNotFoundError)", open(path).read())
