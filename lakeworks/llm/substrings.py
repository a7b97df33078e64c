"""Substring removal against earlier documents, with suffix automata of reference shards.

Every document streams through the automaton of a shard of reference text and
gets its matching statistics: at each word, how far back the text also occurs in
a document with a smaller id.  Windows of 50 words that do are removed.

Sending the automata of the whole corpus to every task would not scale, so each
block of documents gets the shard it can match: hashed phrases
(:mod:`lakeworks.llm.phrases`) tell which blocks share a window with which
document, that document's passage travels to those blocks, at most once to each,
and a block's shard is no longer than what it shares.  What is removed is
decided by the automaton on the words themselves.

Defined results: a null text has no words; documents with fewer words than a
window lose nothing; repeats within a document are kept, and so are those
between rows that share an id; equal ids are never smaller; documents without an
id come after all others and never serve as reference; an empty table gives no
rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm import phrases as P
from lakeworks.llm.arrays import WORD_BASE, prefix_sums, spans_hash, text_slices, word_hashes, words
from lakeworks.llm.automata import SuffixAutomaton
from lakeworks.llm.phrases import (
    PACKED,
    PACKED_SQL,
    Shape,
    bucket_bits,
    contains,
    gathered,
    packed,
    packed_phrases,
    runs,
    single_windows,
    stretches,
)

LENGTH = 50
SLICE_BYTES = 1 << 20
#: Words of the short windows by which a task finds where its shard can match.
PROBE = 8
LAST = (1 << 63) - 1
OPEN, WANTED_STRETCH, WANTED_WINDOW = 1, 2, 3
REQUEST = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("entries", pa.binary())])
REQUEST_SQL = "block int, kind int, entries binary"
PASSAGE = pa.schema([("block", pa.int32()), ("owner", pa.int64()), ("passage", pa.string())])
PASSAGE_SQL = "block int, owner long, passage string"


def shape_for(length: int) -> Shape:
    """Triggers of 2 words, one in 10; reaches of about a third, two thirds and four fifths of the length."""
    return Shape(length, 2, 10, (length * 32 // 100, length * 64 // 100, length * 80 // 100), WORD_BASE)


def _parsed(column: pa.ChunkedArray, shape: Shape) -> Iterator[tuple]:
    """First row, bytes, offsets, word starts and ends, first words, word hashes, stretches of each slice."""
    for first, data, offsets in text_slices(column, SLICE_BYTES):
        starts, ends, firsts = words(data, offsets)
        values = word_hashes(data, starts, ends)
        yield first, data, offsets, starts, ends, firsts, values, stretches(values, firsts, shape)


def _owners(table: pa.Table) -> np.ndarray:
    """Ids as unsigned numbers of the same order; no id is last."""
    ids = [LAST if i is None else i for i in table.column("doc_id").to_pylist()]
    return np.array(ids, dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _least_first(entries: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries (first, second, owner) in order, their blocks, runs of (first, second), and the start of each run."""
    order = np.lexsort((blocks, entries[:, 2], entries[:, 1], entries[:, 0]))
    entries, blocks = entries[order], blocks[order]
    both = runs(entries[:, 0], entries[:, 1])
    return entries, blocks, both, np.flatnonzero(np.diff(both, prepend=-1))


def _least_per_block(entries: np.ndarray) -> np.ndarray:
    """The least owner and the greatest of each (first, second): what others need from this block, and it from them."""
    entries = entries[np.lexsort(entries.T[::-1])]
    both = runs(entries[:, 0], entries[:, 1])
    new = np.diff(both, prepend=-1) != 0
    final = np.diff(both, append=both[-1] + 1 if len(both) else 0) != 0
    return entries[new | final]


def _requests(kind: int, entries: np.ndarray, blocks: np.ndarray, both: np.ndarray, first: np.ndarray) -> pa.Table:
    """To the block of each run's least owner: (second or first, owner, block that wants it)."""
    home, owner = blocks[first][both], entries[first, 2][both]
    later = entries[:, 2] > owner
    named = entries[:, 1] if kind == WANTED_STRETCH else entries[:, 0]
    rows = np.column_stack([home.astype(np.uint64), named, owner, blocks.astype(np.uint64)])[later]
    rows = np.unique(rows, axis=0) if len(rows) else rows
    cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
    parts = np.split(rows, cuts) if len(rows) else []
    return pa.table(
        [
            pa.array([int(p[0, 0]) for p in parts], pa.int32()),
            pa.array([kind] * len(parts), pa.int32()),
            pa.array([np.ascontiguousarray(p[:, 1:]).tobytes() for p in parts], pa.binary()),
        ],
        schema=REQUEST,
    )


def _by_kind(table: pa.Table, kind: int, columns: int) -> np.ndarray:
    blobs = [b for k, b in zip(table.column("kind").to_pylist(), table.column("entries").to_pylist()) if k == kind]
    entries = np.frombuffer(b"".join(blobs), dtype=np.uint64).reshape(-1, columns)
    return entries[np.lexsort(entries.T[::-1])]


def earlier_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and the spans of words removed.

    ``spans`` is an array of (start, end) in words.  With ``with_text`` the kept
    words, joined by blanks, come along.
    """
    shape = shape_for(length)
    n_blocks, total = P.block_count(docs, text)
    bits = bucket_bits(total // 50)
    texts = P.blocked(docs, key, text, n_blocks)
    probe = min(PROBE, length)

    def phrase_entries(table: pa.Table) -> pa.Table:
        owners, parts = _owners(table), [np.zeros((0, 3), np.uint64)]
        for first, *_, s in _parsed(table.column("text"), shape):
            parts.append(np.column_stack([s.core, s.context, owners[first + s.text]]))
        return packed_phrases(table.column("block")[0].as_py(), _least_per_block(np.concatenate(parts)), bits, PACKED)

    def judge_phrases(table: pa.Table) -> pa.Table:
        entries, blocks, both, first = _least_first(*gathered(table, 3))
        core = runs(entries[:, 0])
        contexts = np.full(len(core), 2) if P.of_contexts(table, bits) else np.bincount(core[first])[core]
        # the least owner of a context compares its windows, in every block with rows of that id
        opened = (contexts > 1) & (entries[:, 2] == entries[first, 2][both])
        asked = [entries[opened, 1], entries[opened, 2]]
        order = np.argsort(blocks[opened], kind="stable")
        rows, home = np.column_stack(asked)[order], blocks[opened][order]
        cuts = np.flatnonzero(np.diff(home)) + 1
        parts = np.split(rows, cuts) if len(rows) else []
        firsts = home[np.concatenate(([0], cuts))].tolist() if len(rows) else []
        own = pa.table(
            [
                pa.array(firsts, pa.int32()),
                pa.array([OPEN] * len(parts), pa.int32()),
                pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary()),
            ],
            schema=REQUEST,
        )
        return pa.concat_tables([own, _requests(WANTED_STRETCH, entries, blocks, both, first)])

    def chosen(s, owners: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Stretches named by (context, owner)."""
        which = np.flatnonzero(contains(np.unique(asked[:, 0]), s.context))
        named = s.context[which] * np.uint64(3) ^ owners[which]
        return which[contains(np.unique(asked[:, 0] * np.uint64(3) ^ asked[:, 1]), named)]

    def window_entries(table: pa.Table, flags: pa.Table) -> pa.Table:
        if not table.num_rows:
            return PACKED.empty_table()
        asked, ids, parts = _by_kind(flags, OPEN, 2), _owners(table), [np.zeros((0, 3), np.uint64)]
        for first, *_, s in _parsed(table.column("text"), shape) if len(asked) else ():
            owners = ids[first + s.text]
            owner, _, window = single_windows(s, chosen(s, owners, asked), shape)
            parts.append(np.column_stack([window, s.core[owner], owners[owner]]))
        return packed(table.column("block")[0].as_py(), _least_per_block(np.concatenate(parts)), bits, PACKED)

    def judge_windows(table: pa.Table) -> pa.Table:
        return _requests(WANTED_WINDOW, *_least_first(*gathered(table, 3)))

    def passages(table: pa.Table, flags: pa.Table) -> pa.Table:
        """Runs of wanted windows as text, for each block that wants them."""
        out: list[list] = [[], [], []]
        whole, single = _by_kind(flags, WANTED_STRETCH, 3), _by_kind(flags, WANTED_WINDOW, 3)
        ids = _owners(table) if table.num_rows else None
        for first, data, _, starts, ends, firsts, _, s in (
            _parsed(table.column("text"), shape) if ids is not None and len(whole) + len(single) else ()
        ):
            owners = ids[first + s.text]
            wanted: list[np.ndarray] = []  # (block, owner, first word, end word)
            which = chosen(s, owners, whole)
            wanted.append(_spread(whole, s.context[which], owners[which], s.lo[which], s.hi[which] + length))
            near = np.flatnonzero(contains(np.unique(single[:, 1]), owners)) if len(single) else np.zeros(0, np.int64)
            at, start, window = single_windows(s, near, shape)
            wanted.append(_spread(single, window, owners[at], start, start + length))
            rows = np.concatenate(wanted)
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            text_of = np.searchsorted(firsts, rows[:, 2], side="right")
            begin = 0
            for k in range(1, len(rows) + 1):
                joined = (
                    k < len(rows)
                    and rows[k, 0] == rows[begin, 0]
                    and text_of[k] == text_of[begin]
                    and rows[k, 2] <= rows[begin:k, 3].max()
                )
                if joined:
                    rows[begin, 3] = max(rows[begin, 3], rows[k, 3])
                    continue
                if begin < len(rows):
                    a, b = rows[begin, 2], rows[begin, 3]
                    out[0].append(int(rows[begin, 0]))
                    out[1].append(int(np.uint64(rows[begin, 1].astype(np.uint64) ^ np.uint64(1 << 63)).astype(np.int64)))
                    out[2].append(b" ".join(data[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b])).decode(errors="replace"))
                begin = k
        return pa.table([pa.array(c, f.type) for c, f in zip(out, PASSAGE)], schema=PASSAGE)

    def remove(table: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in schema]
        if not table.num_rows:
            return schema.empty_table()
        ids = table.column("doc_id").to_pylist()
        numbers: dict[bytes, int] = {}
        reference = []
        for owner, passage in zip(shard.column("owner").to_pylist(), shard.column("passage").to_pylist()):
            reference.append((owner, [numbers.setdefault(w, len(numbers)) for w in passage.encode().split(b" ")]))
        automaton = SuffixAutomaton(reference)
        known = _probes(shard.column("passage"), probe)
        for first, data, offsets, starts, ends, firsts, values, _ in _parsed_words(table.column("text")):
            near = _near(values, firsts, known, probe, length)
            for k in range(len(offsets) - 1):
                a, b = int(firsts[k]), int(firsts[k + 1])
                own = [data[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b])]
                gone = np.zeros(b - a + 1, dtype=np.int64)
                doc = ids[first + k]
                for x, y in near.get(k, ()):
                    sequence = [numbers.get(w, -1) for w in own[x - a : y - a]]
                    for e in automaton.ends_of_earlier(sequence, length, LAST if doc is None else doc):
                        gone[x - a + e + 1 - length] += 1
                        gone[x - a + e + 1] -= 1
                removed = np.cumsum(gone[:-1]) > 0
                kept = b" ".join(w for w, g in zip(own, removed.tolist()) if not g)
                edges = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                row = [doc, len(own), int(removed.sum()), hashlib.sha256(kept).hexdigest()]
                row.append([{"start": s, "end": e} for s, e in edges.tolist()])
                if with_text:
                    row.append(kept.decode(errors="replace"))
                for column, value in zip(out, row):
                    column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("spans", pa.list_(span))] + ([("kept_text", pa.string())] if with_text else [])
    schema = pa.schema(fields)
    sql = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    sql += ", kept_text string" if with_text else ""

    entries = texts.groupBy("block").applyInArrow(phrase_entries, PACKED_SQL)
    verdicts = entries.groupBy("bucket").applyInArrow(judge_phrases, REQUEST_SQL)
    windows = P.per_block(texts, verdicts, window_entries, PACKED_SQL)
    more = windows.groupBy("bucket").applyInArrow(judge_windows, REQUEST_SQL)
    shards = P.per_block(texts, verdicts.filter(F.col("kind") != OPEN).unionByName(more), passages, PASSAGE_SQL)
    return P.per_block(texts, shards, remove, sql)


def _spread(asked: np.ndarray, names: np.ndarray, owners: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Rows (block, owner, lo, hi) for every request (name, owner, block) that a span answers."""
    none = np.zeros((0, 4), np.int64)
    if not len(asked) or not len(names):
        return none
    # requests are in order of (name, owner); look each span's run of them up
    keys = asked[:, 0] * np.uint64(3) ^ asked[:, 1]
    order = np.argsort(keys, kind="stable")
    keys, asked = keys[order], asked[order]
    mine = names * np.uint64(3) ^ owners
    first, last = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
    counts = last - first
    which = np.repeat(np.arange(len(names)), counts)
    place = np.repeat(first, counts) + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    same = (asked[place, 0] == names[which]) & (asked[place, 1] == owners[which])
    which, place = which[same], place[same]
    return np.column_stack([asked[place, 2].astype(np.int64), owners[which].view(np.int64), lo[which], hi[which]])


def _parsed_words(column: pa.ChunkedArray) -> Iterator[tuple]:
    for first, data, offsets in text_slices(column, SLICE_BYTES):
        starts, ends, firsts = words(data, offsets)
        yield first, data, offsets, starts, ends, firsts, word_hashes(data, starts, ends), None


def _probe_hashes(values: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the short windows that stay within a text, and their hashes."""
    at = np.arange(max(0, len(values) - size + 1))
    text = np.searchsorted(firsts, at, side="right") - 1
    at = at[at + size <= firsts[text + 1]] if len(at) else at
    return at, spans_hash(prefix_sums(values, WORD_BASE), at, at + size, WORD_BASE)


def _probes(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """Sorted hashes of the short windows of the shard."""
    found = [_probe_hashes(values, firsts, size)[1] for *_, firsts, values, _ in _parsed_words(column)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _near(values: np.ndarray, firsts: np.ndarray, known: np.ndarray, size: int, length: int) -> dict[int, list]:
    """By text, the runs of words all of whose short windows are in the shard and that hold a whole window."""
    found: dict[int, list] = {}
    if not len(known):
        return found
    at, hashes = _probe_hashes(values, firsts, size)
    at = at[contains(known, hashes)]
    if not len(at):
        return found
    text = np.searchsorted(firsts, at, side="right") - 1
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(text) != 0)) + 1
    for part, own in zip(np.split(at, cuts), text[np.concatenate(([0], cuts))].tolist()):
        if part[-1] + size - part[0] >= length:
            found.setdefault(own, []).append((int(part[0]), int(part[-1]) + size))
    return found
