"""Operators where workers cannot import the package, hashes of regular words, samples of repeated ids."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from lakeworks.llm import language, minhash, substrings

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver alone
import os
os.environ.pop("PYTHONPATH", None)
from lakeworks.session import build_session
from lakeworks.llm.queries import QUERIES
spark = build_session("elsewhere", "local[4]", **{{"spark.checkpoint.dir": {shared!r}, "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")
for number in (4, 7, 11, 12, 13):
    name = next(n for n in QUERIES if n.startswith(f"op{{number}}_"))
    print(name, len(QUERIES[name](spark, {folder!r}).collect()))
"""


def test_workers_without_the_package(tmp_path):
    folder = "/root/testdata/sf0.001"
    script = SCRIPT.format(root=str(ROOT), shared=str(tmp_path / "shared"), folder=folder)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [int(line.split()[1]) > 0 for line in done.stdout.splitlines() if line.startswith("op")] == [True] * 5


def regular_words():
    """Two words of 2048 letters whose polynomials are equal modulo 2**64 for any odd base."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_are_told_apart(docs_of):
    one, other = regular_words()
    rows = minhash.near_duplicates(docs_of([one, other, one])).orderBy("doc_id").collect()
    assert [r["component_id"] for r in rows] == [0, 1, 0]
    # a third text that only looks alike is not the earlier source of the passage
    middle = [f"w{k}" for k in range(25)]
    texts = [" ".join([*middle, other, *middle, "x"]), " ".join([*middle, one, *middle]), " ".join(["y", *middle, one, *middle])]
    found = {r["doc_id"]: r["n_removed"] for r in substrings.earlier_spans(docs_of(texts)).collect()}
    assert found == {0: 0, 1: 0, 2: 51}


def test_languages_of_rows_without_own_ids(spark):
    german = F.concat_ws(" ", *[F.element_at(F.array(*map(F.lit, ("der", "und", "nicht", "straße"))), (F.col("id") * k % 4 + 1).cast("int")) for k in range(1, 9)])
    english = F.concat_ws(" ", *[F.element_at(F.array(*map(F.lit, ("the", "and", "not", "road"))), (F.col("id") * k % 4 + 1).cast("int")) for k in range(1, 9)])
    rows = spark.range(4000)
    for key in (F.lit(None).cast("long"), F.lit(5).cast("long")):
        docs = rows.select(key.alias("doc_id"), german.alias("text"), F.lit("de").alias("lang")).unionByName(
            rows.select(F.col("id").alias("doc_id"), english.alias("text"), F.lit("en").alias("lang"))
        )
        found = language.sample_by_label(docs, "lang", "text", "doc_id", 100, 1000)
        assert {name: (n, len(texts)) for name, (n, texts) in found.items()} == {"de": (4000, 100), "en": (4000, 100)}
        assert set(language.fit(docs).dictionaries) == {"de", "en"}
