"""Packing: tokens by the tokenizer itself, gapless sequences, close to the least number."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeworks.llm import packing


def whole(text):
    return np.array(Tokenizer.from_file(packing.default_model()).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_chunks_encode_as_whole_texts():
    rng, encode = random.Random(1), packing._encoder(packing.default_model())
    texts = ["a  b", " x", "\n a", "a \n b", "it's a\n\n  of  ", "ü ß don't 've", "<|endoftext|> a", "a  b", "x "]
    texts += ["".join(rng.choice(" \n\tab.'é1") for _ in range(30)) for _ in range(300)]
    tokenizer = Tokenizer.from_file(packing.default_model())
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [10, 64, 1024])
def test_rounds_place_every_piece_once(capacity):
    rng = random.Random(capacity)
    for n in (1, 7, 300, 5000):
        lengths = [min(capacity, 1 + int(rng.expovariate(3 / capacity))) for _ in range(n)]
        counts = {k: lengths.count(k) for k in set(lengths)}
        places: dict[int, list] = {}
        for length, first, end, sequence, offset in packing.sweep_rounds(counts, capacity):
            for r in range(first, end):
                places.setdefault(sequence + r - first, []).append((offset, length))
        assert sum(map(len, places.values())) == n
        for own in places.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(places) <= 1.1 * sum(lengths) / capacity + 1 + sum(k > capacity // 2 for k in lengths) * (n < 10)


def test_documents(docs_of):
    rng = random.Random(3)
    texts = [None, "", "same", "same", "word " * 3000] + [
        " ".join(rng.choice(["alpha", "beta", "ß", "gamma,"]) for _ in range(rng.randrange(1, 400))) for _ in range(60)
    ]
    docs = docs_of([*enumerate(texts), (2, "same"), (None, "no id")])
    found = packing.pack_documents(docs).collect()
    ids = {k: np.frombuffer(whole(t or ""), "<u4").tolist() + [2] for k, t in enumerate(texts)}
    for k, own in ids.items():
        parts = sorted((r for r in found if r.doc_id == k), key=lambda r: r.piece)
        parts = parts[:1] if k == 2 else parts
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1].tolist()]
        assert sum(r.length for r in parts) == len(own) and all(r.length == 1024 for r in parts[1:])
        for r in parts:
            raw = np.array(own[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(raw)
    by_sequence: dict[int, list] = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= 1024
    assert len(by_sequence) <= -(-sum(r.length for r in found) // 1024) + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_ranks_have_no_gaps(spark, rows):
    items = [(k % 50, 0, 0, 1 + k % 2, 5) for k in range(200)]
    table = spark.createDataFrame(items, "doc_id long, piece int, start long, length long, ids_crc32 long")
    ranks = packing.ranked(table, ["doc_id", "piece"], rows).toPandas()
    for _, own in ranks.groupby("length"):
        assert sorted(own["rank"]) == list(range(len(own)))
