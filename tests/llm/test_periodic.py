"""Periodic runs against a program that tries every period at every place."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import periodic
from lakeworks.llm.wordids import word_ids


def plain_runs(words, least_words=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, exponent * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, q, n) for (s, n), q in found.items())


def plain_collapse(words, runs):
    gone = {k for s, q, n in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts_of(rng):
    words = [str(rng.randrange(rng.choice([1, 2, 3, 12]))) for _ in range(rng.choice([0, 1, 5, 6, 7, 24, 90, 300]))]
    if words and rng.random() < 0.6:
        at = rng.randrange(len(words))
        period = 1 + (len(words) - at) // rng.randint(3, 10)
        words = [w if k < at else words[at + (k - at) % period] for k, w in enumerate(words)]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_a_slice(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [texts_of(rng) for _ in range(rng.randint(1, 7))]
        ids, offsets, _ = word_ids(pa.array([" ".join(t) for t in texts]))
        t, start, length, period = periodic.runs_of(ids, offsets)
        for k, words in enumerate(texts):
            own = t == k
            got = sorted(zip(start[own].tolist(), period[own].tolist(), length[own].tolist()))
            assert got == plain_runs(words)


def test_common_extensions():
    rng = np.random.default_rng(3)
    body = np.concatenate([np.tile(rng.integers(0, 2, 40), 6), rng.integers(0, 2, 300)])
    sequence = np.append(body, [2])
    table = periodic.Extensions(sequence)
    i, j = rng.integers(0, len(body), (2, 4000))
    i, j = i[i != j], j[i != j]
    for a, b, n in zip(i, j, table.common(i, j)):
        want = 0
        while max(a, b) + want < len(body) and body[a + want] == body[b + want]:
            want += 1
        assert n == want


def test_documents(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(texts_of(rng)) for _ in range(120)]
    texts += [None, "", " \t\n", "a " * 5000, "x  y\tx\ny x y x y z", (7, "again again"), (7, "again again"), (None, "b b b b b b")]
    docs = docs_of(texts).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("clash"))
    found = periodic.find_runs(docs).collect()
    assert len(found) == len(texts)
    for row, text in zip(found, texts):
        text = text[1] if isinstance(text, tuple) else text
        words = (text or "").split()
        runs = plain_runs(words)
        assert row["n_words"] == len(words)
        assert [(r["start"], r["period"], r["length"]) for r in row["runs"]] == runs
        assert row["collapsed"] == plain_collapse(words, runs)
    # small slices and few grid places a turn give the same rows
    monkeypatch.setattr(periodic, "SLICE_BYTES", 200)
    monkeypatch.setattr(periodic, "GRID_PLACES", 5)
    assert periodic.find_runs(docs).collect() == found


def test_empty_table(spark, docs_of):
    assert periodic.find_runs(docs_of([(1, "a")]).limit(0)).count() == 0
