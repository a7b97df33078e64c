"""Exact substring removal: every byte in a 200-byte string that also starts elsewhere.

Texts are parsed into phrases at rolling-hash triggers.  The dictionary of
phrases with what follows them tells which stretches of window starts repeat as
a whole, which cannot repeat, and which need a look at their single windows; see
:mod:`lakeworks.llm.phrases`.  The corpus is never sorted as bytes: equality of
200-byte suffix beginnings is all that is asked of the suffix order, so classes
of equal (core, context) and (window, core), 128 bits each, stand for ranks.

Defined results: a null text is empty; texts shorter than the length lose
nothing and take no part; strings of one text that start twice in it count;
rows that repeat, with the same id or another, are copies of each other; null
ids are kept; an empty table gives no rows.  Only the id and text columns are
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeworks.llm import phrases as P
from lakeworks.llm.arrays import BASE, symbols, text_slices
from lakeworks.llm.phrases import (
    PACKED,
    PACKED_SQL,
    Shape,
    answers,
    bucket_bits,
    contains,
    flag_sets,
    gathered,
    packed,
    packed_phrases,
    runs,
    single_windows,
    stretches,
)

LENGTH = 200
SLICE_BYTES = 1 << 20
RESOLVED, OPEN, REPEATED = 0, 1, 2


def shape_for(length: int) -> Shape:
    """Triggers of 8 bytes, one in 32; reaches of about a third, two thirds and four fifths of the length."""
    return Shape(length, 8, 32, (length * 32 // 100, length * 64 // 100, length * 80 // 100), BASE)


def _at_most_twice(entries: np.ndarray) -> np.ndarray:
    """Sorted entries, each at most twice."""
    entries = entries[np.lexsort(entries.T[::-1])]
    if len(entries) < 3:
        return entries
    third = (entries[2:] == entries[:-2]).all(axis=1)
    return entries[np.concatenate(([True, True], ~third))]


def _parsed(column: pa.ChunkedArray, shape: Shape) -> Iterator[tuple]:
    for first, data, offsets in text_slices(column, SLICE_BYTES):
        yield first, data, offsets, stretches(symbols()[data], offsets, shape)


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the spans removed.

    ``spans`` is an array of (start, end) in bytes.  With ``with_text`` the
    remaining text comes along.
    """
    shape = shape_for(length)
    n_blocks, total = P.block_count(docs, text)
    bits = bucket_bits(total // 28)
    texts = P.blocked(docs, key, text, n_blocks)

    def phrase_entries(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        parts = [np.column_stack([s.core, s.context]) for _, _, _, s in _parsed(table.column("text"), shape)]
        return packed_phrases(block, _at_most_twice(np.concatenate(parts)), bits, PACKED)

    def judge_phrases(table: pa.Table) -> pa.Table:
        entries, blocks = gathered(table, 2)
        order = np.lexsort((blocks, entries[:, 1], entries[:, 0]))
        entries, blocks = entries[order], blocks[order]
        core, both = runs(entries[:, 0]), runs(entries[:, 0], entries[:, 1])
        again = np.bincount(both)[both] > 1
        contexts = np.bincount(core[np.flatnonzero(np.diff(both, prepend=-1))])[core]
        if P.of_contexts(table, bits):
            contexts = np.full(len(core), 2)
        owner = np.diff(both, prepend=-1) != 0  # one block compares the windows of a context
        new = np.diff(runs(both, blocks), prepend=-1) != 0
        return answers(
            [
                (RESOLVED, blocks[again & new], entries[again & new, 1]),
                (OPEN, blocks[owner & (contexts > 1)], entries[owner & (contexts > 1), 1]),
            ]
        )

    def window_entries(table: pa.Table, flags: pa.Table) -> pa.Table:
        if not table.num_rows:
            return PACKED.empty_table()
        block = table.column("block")[0].as_py()
        sets = {k: v[:, 0] for k, v in flag_sets(flags).items()}
        parts = [np.zeros((0, 2), np.uint64)]
        for _, _, _, s in _parsed(table.column("text"), shape) if OPEN in sets else ():
            asked = np.flatnonzero(contains(sets[OPEN], s.context))
            twice = contains(sets.get(RESOLVED), s.context[asked])
            for which in (asked, asked[twice]):  # a context that repeats counts as two
                owner, _, window = single_windows(s, which, shape)
                parts.append(np.column_stack([window, s.core[owner]]))
        return packed(block, _at_most_twice(np.concatenate(parts)), bits, PACKED)

    def judge_windows(table: pa.Table) -> pa.Table:
        entries, blocks = gathered(table, 2)
        order = np.lexsort((blocks, entries[:, 1], entries[:, 0]))
        entries, blocks = entries[order], blocks[order]
        both = runs(entries[:, 0], entries[:, 1])
        again = (np.bincount(both)[both] > 1) & (np.diff(runs(both, blocks), prepend=-1) != 0)
        return answers([(REPEATED, blocks[again], entries[again, 0])])

    def remove(table: pa.Table, flags: pa.Table) -> pa.Table:
        sets = {k: v[:, 0] for k, v in flag_sets(flags).items()}
        out: list[list] = [[] for _ in schema]
        ids = table.column("doc_id").to_pylist() if table.num_rows else []
        for first, data, offsets, s in _parsed(table.column("text"), shape) if ids else ():
            change = np.zeros(len(data) + 1, dtype=np.int64)
            whole = contains(sets.get(RESOLVED), s.context)
            np.add.at(change, s.lo[whole], 1)
            np.subtract.at(change, s.hi[whole] + length, 1)
            asked = np.flatnonzero(contains(sets.get(OPEN), s.context) & ~whole)
            _, start, window = single_windows(s, asked, shape)
            start = start[contains(sets.get(REPEATED), window)]
            np.add.at(change, start, 1)
            np.subtract.at(change, start + length, 1)
            gone = np.cumsum(change[:-1]) > 0
            for k in range(len(offsets) - 1):
                own, removed = data[offsets[k] : offsets[k + 1]], gone[offsets[k] : offsets[k + 1]]
                edges = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0))
                kept = own[~removed].tobytes()
                row = [ids[first + k], len(own), int(removed.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()]
                row.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                if with_text:
                    row.append(kept.decode(errors="replace"))
                for column, value in zip(out, row):
                    column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    fields += [("kept_sha256", pa.string()), ("spans", pa.list_(span))] + ([("kept_text", pa.string())] if with_text else [])
    schema = pa.schema(fields)
    sql = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    sql += ", kept_text string" if with_text else ""

    phrases = texts.groupBy("block").applyInArrow(phrase_entries, PACKED_SQL)
    verdicts = P.per_bucket(phrases, judge_phrases)
    windows = P.per_block(texts, verdicts, window_entries, PACKED_SQL)
    repeats = P.per_bucket(windows, judge_windows)
    return P.per_block(texts, verdicts.unionByName(repeats), remove, sql)
