"""Exact and word-level substring removal against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from lakeworks.llm import automata, exact_substrings, phrases, substrings

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def removed_bytes(docs, length):
    seen: dict[bytes, int] = {}
    for _, text in docs:
        for s in range(len(text) - length + 1):
            seen[text[s : s + length]] = seen.get(text[s : s + length], 0) + 1
    for i, text in docs:
        gone = [False] * len(text)
        for s in range(len(text) - length + 1):
            if seen[text[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        n_spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        yield i, len(text), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()


def removed_words(docs, length):
    first: dict[tuple, int] = {}
    split = [(i, WORD.findall(text)) for i, text in docs]
    for i, listed in split:
        for s in range(len(listed) - length + 1):
            window = tuple(listed[s : s + length])
            first[window] = min(first.get(window, i), i)
    for i, listed in split:
        gone = [False] * len(listed)
        for s in range(len(listed) - length + 1):
            if first[tuple(listed[s : s + length])] < i:
                gone[s : s + length] = [True] * length
        kept = b" ".join(w for w, g in zip(listed, gone) if not g)
        yield i, len(listed), sum(gone), hashlib.sha256(kept).hexdigest()


def mixed_texts(rng, vocabulary, joint, own, shared):
    """Random texts with shared passages, copies, runs of one symbol, periodic and empty texts."""
    base = [[rng.choice(vocabulary) for _ in range(shared)] for _ in range(4)]
    texts = [None, "", joint.join([vocabulary[0]] * (2 * shared)), joint.join(vocabulary[:2] * shared), "short"]
    for _ in range(50):
        b, i = rng.choice(base), rng.randrange(shared * 2 // 3)
        middle = b[i : i + rng.randrange(shared // 10, shared)]
        texts.append(joint.join([*rng.choices(vocabulary, k=rng.randrange(own)), *middle, *rng.choices(vocabulary, k=rng.randrange(own))]))
    return texts + texts[10:14]


@pytest.mark.parametrize("length", [200, 40])
def test_bytes(docs_of, monkeypatch, length):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(exact_substrings, "SLICE_BYTES", 1500)
    rng = random.Random(length)
    texts = mixed_texts(rng, list("abé c"), "", 200, 600)
    found = exact_substrings.repeated_spans(docs_of(texts), length=length, with_text=True).collect()
    want = removed_bytes([(k, (t or "").encode()) for k, t in enumerate(texts)], length)
    assert sorted(tuple(r)[:5] for r in found) == sorted(want)
    for r in found:
        own = (texts[r.doc_id] or "").encode()
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        kept = b"".join(own[a:b] for a, b in zip([0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(own)]))
        assert kept.decode(errors="replace") == r.kept_text


@pytest.mark.parametrize("length", [50, 12])
def test_words(docs_of, monkeypatch, length):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(substrings, "SLICE_BYTES", 1500)
    rng = random.Random(length)
    texts = mixed_texts(rng, ["a", "b", "the", "é", "xyz", "of"], " ", 70, 200)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = list(zip(ids, texts))
    found = substrings.earlier_spans(docs_of(docs), length=length).collect()
    want = removed_words([(i, (t or "").encode()) for i, t in docs], length)
    assert sorted(tuple(r)[:4] for r in found) == sorted(want)


def test_repeated_rows_and_missing_ids(docs_of):
    passage = " ".join(f"w{k}" for k in range(80))
    docs = docs_of([(3, passage), (3, passage), (None, passage), (5, passage + " x"), (1, None)])
    by_bytes = exact_substrings.repeated_spans(docs).collect()
    assert sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in by_bytes) == [(0, 0), (1, 0), (3, 0), (3, 0), (5, 2)]
    by_words = substrings.earlier_spans(docs).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in by_words) == [(0, 80), (1, 0), (3, 0), (3, 0), (5, 80)]
    empty = docs.limit(0)
    assert exact_substrings.repeated_spans(empty).count() == substrings.earlier_spans(empty).count() == 0


def test_rows_that_share_an_id_in_several_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
    rng = random.Random(5)

    def own(n):
        return [f"o{rng.randrange(10**9)}" for _ in range(n)]

    passage, ending = own(70), own(60)
    around = lambda first, last: " ".join([*own(40), *first, *last, *own(40)])
    docs = [(1, around(passage, own(60)))]
    # the same stretch in several rows of one id, with surroundings other than in the earlier document
    docs += [(i, around(passage, ending)) for i in (None,) * 8 + (7,) * 8]
    found = substrings.earlier_spans(docs_of(docs)).collect()
    assert phrases.block_count(docs_of(docs), "text")[0] > 5
    assert sorted(r.n_removed for r in found if r.doc_id == 7) == [70] * 8
    assert sorted(r.n_removed for r in found if r.doc_id is None) == [130] * 8
    only = [d for d in docs if d[0] != 7]
    assert sorted(r.n_removed for r in substrings.earlier_spans(docs_of(only)).collect()) == [0] + [70] * 8


@pytest.mark.parametrize("block_bytes", [1500, 30_000])
def test_boilerplate_in_ever_new_surroundings(docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block_bytes)
    rng = random.Random(block_bytes)
    line = [f"b{rng.randrange(10**6)}" for _ in range(70)]

    def own(n):
        return [f"o{rng.randrange(10**9)}" for _ in range(n)]

    def around(k):
        first = rng.randrange(20)
        return " ".join([*own(k % 9), *line[first : first + rng.choice((38, 45, 50, 56))], *own(k % 7)])

    texts = [around(k) for k in range(160)]
    ids = rng.sample(range(1000), len(texts))
    docs = list(zip(ids, texts))
    raw = [(i, t.encode()) for i, t in docs]
    found = substrings.earlier_spans(docs_of(docs)).collect()
    assert sorted(tuple(r)[:4] for r in found) == sorted(removed_words(raw, 50))
    found = exact_substrings.repeated_spans(docs_of(docs)).collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(removed_bytes(raw, 200))


def test_a_core_of_many_contexts_is_dealt_by_context():
    rng = np.random.default_rng(8)
    hot = np.column_stack([np.full(4000, 1 << 40, np.uint64), rng.integers(0, 1 << 63, 4000).astype(np.uint64)])
    rest = rng.integers(0, 1 << 63, (500, 2)).astype(np.uint64)
    entries = np.concatenate([hot, rest])
    entries = entries[np.lexsort(entries.T[::-1])]
    dealt = phrases.packed_phrases(3, entries, 4, phrases.PACKED).to_pylist()
    by_bucket = {r["bucket"]: np.frombuffer(r["entries"], np.uint64).reshape(-1, 2) for r in dealt}
    assert len(by_bucket) == len(dealt) and {r["block"] for r in dealt} == {3}
    by_core = np.concatenate([v for b, v in by_bucket.items() if b < 16])
    assert (by_core[:, 0] == hot[0, 0]).sum() == phrases.FEW_CONTEXTS and len(by_core) == 500 + phrases.FEW_CONTEXTS
    spread = [v for b, v in by_bucket.items() if b >= 16]
    assert len(spread) == 16 and max(map(len, spread)) < 400
    assert sorted(map(tuple, np.concatenate(spread).tolist())) == sorted(map(tuple, hot.tolist()))
    assert phrases.packed_phrases(0, entries[:0], 4, phrases.PACKED).num_rows == 0


def test_automaton_knows_every_substring():
    rng = random.Random(1)
    for _ in range(100):
        reference = [(owner, rng.choices(range(3), k=rng.randrange(1, 12))) for owner in rng.sample(range(9), 3)]
        automaton = automata.SuffixAutomaton(reference)
        text, size, owner = rng.choices(range(4), k=15), rng.randrange(1, 5), rng.randrange(9)
        want = [
            e
            for e in range(size - 1, len(text))
            if any(
                o < owner and any(s[k : k + size] == text[e - size + 1 : e + 1] for k in range(len(s) - size + 1))
                for o, s in reference
            )
        ]
        assert list(automaton.ends_of_earlier(text, size, owner)) == want


def test_stretches_cover_every_window_once():
    rng = np.random.default_rng(4)
    shape = exact_substrings.shape_for(40)
    values = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    offsets = np.array([0, 130, 130, 150, 500])
    found = phrases.stretches(values, offsets, shape)
    starts = sorted(s for lo, hi in zip(found.lo, found.hi) for s in range(lo, hi + 1))
    assert starts == [*range(0, 91), *range(150, 461)]
