"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from lakeworks.llm import components, minhash
from lakeworks.session import filed_by

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def shingles(text, n):
    listed = WORD.findall((text or "").translate(LOWER))
    if len(listed) < n:
        return frozenset([tuple(listed)] if listed else [])
    return frozenset(tuple(listed[k : k + n]) for k in range(len(listed) - n + 1))


def groups(docs, n, percent=80):
    sets = {i: shingles(t, n) for i, t in docs}
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                least[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(rng, n):
    """Families of texts with a few words changed, so that similarities lie on both sides of the threshold."""
    vocabulary = [f"w{k}" for k in range(500)] + ["The", "É", "of"]
    texts = [None, "", "One", "one", "two Words", "TWO words", " \t\n"]
    for _ in range(n):
        base = rng.choices(vocabulary, k=rng.randrange(5, 120))
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 12) + 1)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("n_words", [2, 5])
def test_components_of_near_duplicates(docs_of, n_words):
    rng = random.Random(n_words)
    texts = variants(rng, 40)
    ids = rng.sample(range(10_000), len(texts))
    docs = list(zip(ids, texts))
    found = minhash.near_duplicates(docs_of(docs), n_words=n_words).collect()
    want = groups(docs, n_words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_one_of_each_group_stays(docs_of):
    docs = docs_of([(4, "a b c"), (4, "a b c"), (2, "A b c"), (9, "x y z"), (9, "q r s t"), (None, "a b c"), (7, None), (8, "")])
    left = minhash.deduplicated(docs, n_words=2)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(2, "A b c"), (9, "x y z"), (9, "q r s t"), (None, "a b c"), (7, None), (8, "")], key=str
    )
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_another_text_of_a_removed_id_stays(docs_of):
    left = minhash.deduplicated(docs_of([(2, "A b c"), (9, "a b c"), (9, "x y z"), (9, "x y z"), (9, None)]), n_words=2)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == [(2, "A b c"), (9, "x y z"), (9, None)]


def test_long_chain_is_one_component(spark):
    rng = random.Random(8)
    nodes = rng.sample(range(1000), 300)
    edges = list(zip(nodes, nodes[1:])) + [(2000, 2001), (5, 5)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[n] == min(nodes) for n in nodes)
    assert found[2001] == found[2000] == 2000


@pytest.mark.parametrize("limits", [(2, 3, 1 << 22), (4, 50, 200)])
def test_buckets_beyond_a_task(docs_of, monkeypatch, limits):
    """Buckets dealt into pieces, by members or by shingles, give the components of whole ones."""
    for name, value in zip(("CENTRES", "PIECE_MEMBERS", "TASK_SHINGLES"), limits):
        monkeypatch.setattr(minhash, name, value)
    rng = random.Random(sum(limits))
    docs = list(enumerate(variants(rng, 2)))
    base = [f"w{k}" for k in range(60)]
    for k in range(10):
        own = list(base)
        own[k] = own[k + 20] = f"new{k}"
        docs.append((1000 + k, " ".join(own)))
    found = minhash.near_duplicates(docs_of(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(docs, 2)


def test_links_grow_with_the_members():
    """A group of like sets gives a tree, in which only what is not connected yet is tested."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.sort(np.concatenate([base[3:], rng.integers(0, 2**63, 3).astype(np.uint64)])) for _ in range(300)]
    family = minhash.hash_family(200)
    signs = np.stack([(minhash.minima(s, family) & np.uint32(255)).astype(np.uint8) for s in sets])
    links = minhash.forest(np.arange(300), signs, sets, 0, 80)
    assert len(links) == 299 and len({k for link in links for k in link}) == 300
    assert minhash.forest(np.arange(300) // 150, signs, sets, 0, 80) == [(0, 1)]
    assert len(minhash.forest(np.arange(300), signs, sets, 4, 80)) == 299


def test_few_links_need_no_rounds(spark, monkeypatch):
    """Few links are joined without a round; many by rounds, with the same components."""
    rng = random.Random(3)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(300)] + [(2**62, -(2**62)), (7, 7)]
    links = spark.createDataFrame(edges, "a long, b long")
    by_rounds = []
    with monkeypatch.context() as patch:
        patch.setattr(components, "FEW_LINKS", 0)
        cut = components.cut_lineage
        patch.setattr(components, "cut_lineage", lambda df, label: by_rounds.append(label) or cut(df, label))
        want = {tuple(r) for r in components.components(links).collect()}
        assert len(by_rounds) > 2
        del by_rounds[:]
        patch.setattr(components, "FEW_LINKS", 1000)
        found = components.components(links).collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want) and not by_rounds
    assert components.components(links.filter("a = b")).collect() == []


def test_components_by_rounds(docs_of, monkeypatch):
    for module in (components, minhash):
        monkeypatch.setattr(module, "FEW_LINKS", 0)
    rng = random.Random(11)
    docs = list(enumerate(variants(rng, 20)))
    found = minhash.near_duplicates(docs_of(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(docs, 2)


def test_buckets_of_equal_members_are_compared_once(docs_of, monkeypatch):
    """Two sets below the threshold meet in several bands; their sets are brought together once."""
    base = [f"w{k}" for k in range(200)]
    other = [f"new{k}" if k in (20, 40, 60, 80, 100, 120, 140, 160, 180, 190, 30, 50) else w for k, w in enumerate(base)]
    docs = docs_of([(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(other)), (4, "x y z")])
    met, links = [], minhash._links
    monkeypatch.setattr(minhash, "_links", lambda rows, *rest: met.append(rows.count()) or links(rows, *rest))
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    shared = minhash.signatures(docs, "doc_id", "text").filter("doc_id < 3").selectExpr("explode(bands) b").groupBy("b").count()
    assert shared.filter("count = 2").count() > 1
    assert found == {1: 1, 2: 2, 3: 2, 4: 4} and met == [2]


def test_filed_rows_are_not_shuffled_again(spark):
    rows = spark.range(100).selectExpr("id node", "cast(id as string) value")
    with filed_by(rows.repartition("node"), "node", "filed") as filed:
        joined = filed.hint("merge").join(spark.range(0, 200, 2).selectExpr("id node"), "node")
        assert joined.count() == 50
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("filed")]


def test_settled_buckets_take_no_further_turn(docs_of, monkeypatch):
    """Large buckets whose members outside the largest component were all centres are not looked into again."""
    monkeypatch.setattr(minhash, "PIECE_MEMBERS", 3)
    labelled, seen = minhash._labelled, []
    monkeypatch.setattr(minhash, "_labelled", lambda entries, found: seen.append(entries.count()) or labelled(entries, found))
    base = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join([*base[:k], f"new{k}", *base[k + 1 :]])) for k in range(8)]
    found = minhash.near_duplicates(docs_of(docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == groups(docs, 2)
    assert 0 in seen  # after a turn in which all were centres no entry is left
