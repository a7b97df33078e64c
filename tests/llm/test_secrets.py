"""Secret spans against Python's matcher and against SQL; the index; the plan."""

from __future__ import annotations

import hashlib
import os
import random
import re

import compare
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import secret_scan
from lakeworks.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def spans(text):
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), rank, rule.kind, m.end()))
    return sorted(found)


def random_text(rng):
    menu = [
        "password", "Passwd", "SECRET", "token", "api_key", "apikey", "=", ": ", " = ", '"', "'", "abc", "x1/y+z=", "AKIA",
        "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", " ", "\n", "é", "ghp_", "A1b2" * 10, "xoxb-", "-----BEGIN RSA PRIVATE KEY-----",
        "eyJ", "abcdefghijk.", "🙂",
    ]
    return "".join(rng.choices(menu, k=rng.randrange(0, 40)))


def test_spans_and_masks(docs_of):
    rng = random.Random(6)
    texts = [None, "", "plain", "secret=token: abcdefgh", "password=" + "a" * 50_000] + [random_text(rng) for _ in range(400)]
    texts += texts[5:8]
    docs = docs_of(texts)
    found = secret_scan.scan(docs)
    for r in found.withColumn("masked", secret_scan.masked(found["text"], found["secrets"])).collect():
        assert [tuple(s) for s in r.secrets] == spans(r.text)
        out, at = "", 0
        for start, _, _, end in spans(r.text):
            if start >= at:
                out += r.text[at:start] + secret_scan.MASK
            at = max(at, end)
        assert r.masked == (None if r.text is None else out + r.text[at:] if spans(r.text) else r.text)
    listed = {r.doc_id: r for r in secret_scan.report(docs).collect()}
    for k, text in enumerate(texts):
        base = ",".join(f"{kind}:{a}:{b}" for a, rank, kind, b in spans(text) if rank < 3)
        assert listed[k].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert listed[k].n_hex == sum(s[2] == "hex" for s in spans(text))


def test_queries_are_mandatory():
    """No text matches a rule without fulfilling its trigram query."""
    rng = random.Random(7)
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.pattern)
        assert bool(query) == (rule.kind != "hex")
        for _ in range(300):
            text = random_text(rng)
            if re.search(rule.pattern, text):
                assert all(any(all(t in text.lower() for t in o) for o in clause) for clause in query)


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        (r"abcd", [[{"abc", "bcd"}]]),
        (r"(abc|xyz)\d+def", [[{"abc"}, {"xyz"}], [{"def"}]]),
        (r"ab?cd", [[{"abc", "bcd"}, {"acd"}]]),
        (r"a.b.c|\w+", []),
        (r"[ab]cd", [[{"acd"}, {"bcd"}]]),
    ],
)
def test_trigram_queries(pattern, want):
    assert [[set(o) for o in clause] for clause in secret_scan.trigram_query(pattern)] == want


def test_matches_sql_without_python(spark):
    df = QUERIES["op5_secret_scan"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions|NestedLoop|Cartesian", plan)
    assert compare.difference(df, compare.connect(FOLDER), ORACLES["op5_secret_scan"]) is None


def test_odd_rows(docs_of):
    docs = docs_of([(None, "token=abcdefgh"), (1, "token=abcdefgh"), (1, "token=abcdefgh"), (1, "clean")])
    assert sorted(len(r.secrets) for r in secret_scan.scan(docs).collect()) == [0, 1, 1, 1]
    assert secret_scan.report(docs.limit(0)).count() == 0


def test_text_of_many_spans(docs_of):
    """Spans and masks of texts with thousands of secrets; the time grows far less than with their square."""
    rng = random.Random(20)
    words = ["password=abcdef12", "é🙂", "AKIA" + "Q" * 16, "secret: token=0123456789abcdef01234567", "plain"]
    texts = [" ".join(rng.choices(words, k=k)) for k in (5_000, 30_000)]
    for r in secret_scan.scan(docs_of(texts)).withColumn("masked", secret_scan.masked(F.col("text"), F.col("secrets"))).collect():
        assert [tuple(s) for s in r.secrets] == spans(r.text)
        out, at = [], 0
        for start, _, _, end in spans(r.text):
            if start >= at:
                out += [r.text[at:start], secret_scan.MASK]
            at = max(at, end)
        assert r.masked == "".join(out) + r.text[at:]
