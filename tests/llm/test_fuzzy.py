"""Fingerprints: edits by brute force, distances against dynamic programming, odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest

from lakeworks.llm import fuzzy


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for k, y in enumerate(b):
            row[k + 1] = before[k] + 1 if x == y else max(before[k + 1], row[k])
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcd", k=rng.randrange(0, 70))) for _ in range(2))
        assert fuzzy._common_subsequence(a, b) == subsequence(a, b)


def test_likeness_follows_the_share_of_common_text():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(800))
    other = " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(800))
    mine = fuzzy.fingerprint(text)
    changed = fuzzy.fingerprint(text[:2000] + "XYZ" + text[2003:])
    half = fuzzy.fingerprint(text[: len(text) // 2] + other[: len(text) // 2])
    assert fuzzy.likeness(mine, mine) == 1.0
    assert fuzzy.likeness(mine, changed) > 0.9
    assert 0.3 < fuzzy.likeness(mine, half) < 0.8
    assert fuzzy.likeness(mine, fuzzy.fingerprint(other)) < 0.2


@pytest.mark.parametrize("slice_bytes", [1 << 20, 200])
def test_edits(docs_of, monkeypatch, slice_bytes):
    monkeypatch.setattr(fuzzy, "SLICE_BYTES", slice_bytes)
    rng = random.Random(2)
    texts = [None, "", "é", "ab"] + ["".join(rng.choices("abc é\n", k=rng.randrange(1, 120))) for _ in range(40)]
    docs = list(zip(rng.sample(range(-50, 500), len(texts)), texts))
    found = {r.doc_id: r for r in fuzzy.against_edits(docs_of(docs)).collect()}
    ordered = sorted(docs, reverse=True)
    assert len(found) == len(docs)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own = found[i]
        assert own.n_chars == len(text)
        assert own.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert own.fingerprint == fuzzy.fingerprint(text) and own.edited_fingerprint == fuzzy.fingerprint(edited)
        assert own.near_next == fuzzy.likeness(fuzzy.fingerprint(text), fuzzy.fingerprint(following))


def test_odd_rows(docs_of):
    docs = docs_of([(1, "one text"), (1, "one text"), (1, "another"), (None, "last"), (None, None)])
    assert fuzzy.against_edits(docs).count() == 5
    assert fuzzy.against_edits(docs.limit(0)).count() == 0
    alone = fuzzy.against_edits(docs_of(["alone"])).collect()
    assert [r.near_next for r in alone] == [1.0]
    assert "h" in fuzzy.with_fingerprint(docs).columns
