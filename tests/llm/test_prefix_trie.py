"""Tries of conversations against a program that keeps every prefix in a dictionary."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeworks.llm import prefix_trie


def plain_nodes(conversations):
    """Rows of all nodes for {conversation: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[q] for q in children[p])
    rows = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in own if len(conversations[c]) == len(p))
        sha = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((own[0], len(p), members[p[:-1]][0] if p else None, len(own), len(children[p]), leaves[p], saved[p], sha))
    return sorted(rows, key=repr)


def table_of(spark, conversations, start=0):
    rows = [(c, start + k, r, t, "x", "y") for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string, keys string")


def nodes_of(frame):
    return sorted((tuple(r) for r in frame.select(prefix_trie.COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("shard_turns", [100_000, 40, 3])
def test_nodes(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    monkeypatch.setattr(prefix_trie, "OUT_ROWS", 10)
    rng = random.Random(2)
    said = [("user", "hi"), ("user", "é"), ("assistant", "hi"), ("assistant", ""), ("", "")]
    conversations = {c: [rng.choice(said) for _ in range(rng.choice([1, 1, 2, 3, 5, 9]))] for c in range(150)}
    conversations |= {c: [said[0]] * 4 for c in range(200, 260)}  # one group of equal conversations
    conversations |= {300: [said[1]] * 60, 301: [said[1]] * 61}  # long ones
    found = prefix_trie.build(prefix_trie.turn_sequences(table_of(spark, conversations)))
    assert nodes_of(found) == plain_nodes(conversations)


def test_conversations_without_turns(spark):
    rows = [(4, [(b"k" * 16, 3)]), (2, []), (9, [])]
    frame = spark.createDataFrame(rows, "conv_id long, turns array<struct<key: binary, size: long>>")
    ends = [hashlib.sha256(b).hexdigest() for b in (b"2,9", b"4")]
    assert nodes_of(prefix_trie.build(frame)) == [(2, 0, None, 3, 1, 1, 0, ends[0]), (4, 1, 2, 1, 0, 1, 0, ends[1])]


def test_missing_values_and_ties(spark):
    rows = [(1, None, "a", "1"), (1, 0, "b", "2"), (1, 0, None, None), (1, 0, None, None), (None, 1, "c", "3"), (2, None, "a", "1")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = nodes_of(prefix_trie.build(prefix_trie.turn_sequences(frame)))
    again = nodes_of(prefix_trie.build(prefix_trie.turn_sequences(frame.orderBy(F.desc("role")))))
    assert found == again
    assert sorted((r[1], r[3]) for r in found) == [(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)]


def test_empty_table(spark):
    empty = table_of(spark, {1: [("a", "b")]}).limit(0)
    assert prefix_trie.build(prefix_trie.turn_sequences(empty)).count() == 0


def test_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    for k in prefix_trie.median_order(1023):
        tree.insert([k])
    seen, height = [(tree.below[0], 1)], 0
    for node, level in seen:
        height = max(height, level)
        seen += [(n, level + 1) for n in (tree.low[node], tree.high[node]) if n != -1]
    assert (len(seen), height) == (1023, 10)
