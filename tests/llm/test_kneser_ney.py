"""The language model against a program that keeps all counts in dictionaries."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import kneser_ney, shared_arrays


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", lower), "</s>"]


def plain_model(texts, order):
    """Adjusted counts, context sums and discounts of every order."""
    raw = {k: Counter() for k in range(1, order + 1)}
    for t in map(tokens, texts):
        for k in raw:
            raw[k].update(tuple(t[i - k + 1 : i + 1]) for i in range(max(k - 1, 1), len(t)))
    count = {order: dict(raw[order])}
    for k in range(order - 1, 0, -1):
        ends = Counter(g[1:] for g in raw[k + 1])
        count[k] = {g: raw[k][g] if g[0] == "<s>" else ends[g] for g in raw[k]}
    discounts = {}
    for k in count:
        seen = Counter(count[k].values())
        discounts[k] = kneser_ney.discounts_of([seen[j] for j in (1, 2, 3, 4)])
    context = {k: defaultdict(list) for k in count}
    for k in count:
        for g, c in count[k].items():
            context[k][g[:-1]].append(c)
    return raw, count, discounts, context


def plain_score(text, model, order):
    raw, count, discounts, context = model
    vocabulary, total = len(raw[1]), sum(raw[1].values())
    t = tokens(text)
    base = sum(math.log10((raw[1][(w,)] + 1) / (total + vocabulary + 1)) for w in t[1:])
    score = 0
    for i in range(1, len(t)):
        p = 1 / (vocabulary + 1)
        for k in range(1, min(order, i + 1) + 1):
            seen = context[k].get(tuple(t[i - k + 1 : i]))
            if not seen:
                continue
            d = (0, *discounts[k])
            c = count[k].get(tuple(t[i - k + 1 : i + 1]), 0)
            rest = sum(d[min(x, 3)] for x in seen)
            p = max(c - d[min(c, 3)], 0) / sum(seen) + rest / sum(seen) * p
        score += math.log10(p)
    return len(t) - 1, sum(raw[1][(w,)] > 0 for w in t[1:]), total, base, score


def corpus(seed, n, words):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(words)]
    return [" ".join(rng.choices([f"W{k}" for k in range(words)], weights, k=rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("order, words", [(2, 40), (2, 2000), (3, 3), (4, 40)])
def test_scores(spark, docs_of, monkeypatch, order, words):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 300)
    train = corpus(1, 150, words) + [None, "", "the THE Éa éa\tÉA"]
    texts = train + corpus(2, 40, words + 5) + ["only strange words here", "x " * 400]
    docs = docs_of(texts).withColumn("n", F.lit(1)).withColumn("raw", F.lit("clash"))
    model = kneser_ney.fit(docs.filter(F.col("doc_id") < len(train)), order=order, block_tokens=500)
    assert model.bits > 2
    found = {r["doc_id"]: r for r in kneser_ney.score(docs, model, block_tokens=500).collect()}
    assert len(found) == len(texts)
    plain = plain_model(train, order)
    for k, text in enumerate(texts):
        want = plain_score(text, plain, order)
        row = found[k]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == want[:3]
        assert row["base_score"] == pytest.approx(want[3], rel=1e-9)
        assert row["score"] == pytest.approx(want[4], rel=1e-6)
        assert row["perplexity"] == pytest.approx(10 ** (-want[4] / want[0]), rel=1e-5)


def test_probabilities_add_up_to_one():
    plain = plain_model(corpus(4, 80, 12), 2)
    words = [g[0] for g in plain[0][1]]
    for context in ["w0", "w3", "never seen"]:
        mass = 0
        for w in [*words, "something else"]:
            mass += 10 ** (plain_next(context, w, plain))
        assert mass == pytest.approx(1)


def plain_next(context, word, plain):
    raw, count, discounts, contexts = plain
    p = 1 / (len(raw[1]) + 1)
    for k, before in ((1, ()), (2, (context,))):
        seen = contexts[k].get(before)
        if seen:
            d = (0, *discounts[k])
            c = count[k].get((*before, word), 0)
            p = max(c - d[min(c, 3)], 0) / sum(seen) + sum(d[min(x, 3)] for x in seen) / sum(seen) * p
    return math.log10(p)


def test_learned_texts_are_likelier_than_words_alone(spark, docs_of):
    rng = random.Random(8)
    chain = {w: rng.sample(range(50), 3) for w in range(50)}
    texts = []
    for _ in range(200):
        w, out = rng.randrange(50), []
        for _ in range(40):
            out.append(f"w{w}")
            w = rng.choice(chain[w])
        texts.append(" ".join(out))
    docs = docs_of(texts)
    model = kneser_ney.fit(docs.filter("doc_id % 5 > 0"))
    rows = kneser_ney.score(docs.filter("doc_id % 5 = 0"), model).collect()
    assert all(r["score"] > 0.5 * r["base_score"] for r in rows)


def test_nothing_to_learn_from(spark, docs_of):
    docs = docs_of(["a b", None])
    model = kneser_ney.fit(docs.limit(0))
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in kneser_ney.score(docs, model).collect()] == [
        (3, 0, 0, 0.0, 0.0),
        (1, 0, 0, 0.0, 0.0),
    ]
    assert kneser_ney.score(docs.limit(0), model).count() == 0


def test_repeated_and_missing_ids(spark, docs_of):
    docs = docs_of([(None, "a b a"), (5, "a b a"), (5, "a b a"), (5, "c")])
    rows = kneser_ney.score(docs, kneser_ney.fit(docs)).collect()
    assert sorted(r["n_tokens"] for r in rows) == [2, 4, 4, 4]
    assert len({r["score"] for r in rows}) == 2


def test_other_blocks_are_refused(spark, tmp_path):
    spark.range(400).selectExpr("id AS doc_id", "concat('w', id % 7, ' v', id) AS text").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    scored = kneser_ney.score(docs, kneser_ney.fit(docs), block_tokens=100)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
        with pytest.raises(Exception, match="other blocks"):
            scored.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_arrays_come_back(tmp_path):
    arrays = {"a": np.arange(5, dtype="<u8"), "b": np.zeros(0, "<f4"), "c": np.arange(3, dtype="u1")}
    for folder in (str(tmp_path), tmp_path.as_uri()):
        shared_arrays.save(folder, "x", arrays)
        found = shared_arrays.load(folder, "x")
        assert all((found[k] == v).all() and found[k].dtype == v.dtype for k, v in arrays.items())
    assert shared_arrays.load(str(tmp_path), "y") is None
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64) * np.uint64(2))
    assert (kneser_ney.unpack_sorted(kneser_ney.pack_sorted(keys)) == keys).all()
