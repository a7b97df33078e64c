"""Repeated windows of symbol sequences by prefix-free parsing, in blocks of texts.

A rolling hash over a few symbols sets triggers; the window starts between two
triggers, at most ``reach`` symbols before the second, form a stretch.  All its
windows contain the same core, the symbols right after the trigger, and lie in
one context.  Two equal windows have their first trigger at the same place, so
they lie in stretches with equal cores: the dictionary of (core, context) says
where repeats can be.

* Equal contexts: every window of the stretch repeats.
* One core under several contexts: the windows themselves are compared.
* A core that occurs once: no window of the stretch repeats.

Windows without a trigger in reach are stretches of their own.  Entries travel
in packed arrays between blocks of texts and buckets of hashes.  A block names
an entry at most twice, so a passage that a third of all texts share is a few
entries a block.  A block that sees a core under more than ``FEW_CONTEXTS`` contexts
knows already that its windows must be compared: it deals those entries by their
context and tells the core's bucket of two only.  So boilerplate in ever new
surroundings is a few entries a block in one bucket too, and the rest is spread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import mix, powers, prefix_sums, spans_hash

#: Text of a block, entries of a bucket.
BLOCK_BYTES, BUCKET_ENTRIES = 4 << 20, 100_000
#: Contexts of one core that a block sends to the core's bucket; two are enough to tell that there are several.
FEW_CONTEXTS = 2


@dataclass(frozen=True)
class Shape:
    """Length of the windows and of the triggers, one trigger in ``every`` positions, reaches of the stretches."""

    length: int
    trigger: int
    every: int
    reaches: tuple[int, ...]
    base: int


@dataclass
class Stretches:
    """Stretches of window starts ``lo..hi``, both included, with their text, core and context."""

    lo: np.ndarray
    hi: np.ndarray
    text: np.ndarray
    core: np.ndarray
    context: np.ndarray
    sums: np.ndarray


def stretches(values: np.ndarray, offsets: np.ndarray, shape: Shape) -> Stretches:
    """Stretches of the sequence ``values``, cut into texts at ``offsets``."""
    n, size, width = len(values), shape.length, shape.trigger
    sums = prefix_sums(values, shape.base)
    if n < size:
        none = np.zeros(0, np.int64)
        return Stretches(none, none, none, none.astype(np.uint64), none.astype(np.uint64), sums)
    rolled = (sums[width:] - sums[:-width]) * powers(shape.base, n)[1][: n - width + 1]
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    triggers = np.flatnonzero((rolled >> np.uint64(40)) % np.uint64(shape.every) == 0)
    text = np.searchsorted(offsets, triggers, side="right") - 1
    inside = triggers + width <= offsets[text + 1]
    triggers, text = triggers[inside], text[inside]
    begin, end = offsets[text], offsets[text + 1]
    before = np.concatenate(([-1], triggers[:-1]))
    least = np.maximum(before + 1, begin)
    last = np.minimum(triggers, end - size)
    lo, hi, of, core = [], [], [], []
    covered = np.zeros(n + 1, dtype=np.int32)
    nearest = 0
    for reach in shape.reaches:
        first = np.maximum(least, triggers - reach + 1)
        final = np.minimum(last, triggers - nearest)
        some = np.flatnonzero(first <= final)
        lo.append(first[some])
        hi.append(final[some])
        of.append(text[some])
        at = triggers[some]
        core.append(spans_hash(sums, at, at + size - reach + 1, shape.base) ^ np.uint64(reach))
        np.add.at(covered, first[some], 1)
        np.subtract.at(covered, final[some] + 1, 1)
        nearest = reach
    lo, hi, of, core = map(np.concatenate, (lo, hi, of, core))
    context = spans_hash(sums, lo, hi + size, shape.base) ^ mix((hi - lo).astype(np.uint64))
    # windows that no stretch covers
    starts = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    starts_text = np.searchsorted(offsets, starts, side="right") - 1
    fits = starts + size <= offsets[np.minimum(starts_text + 1, len(offsets) - 1)]
    starts, starts_text = starts[fits], starts_text[fits]
    alone = spans_hash(sums, starts, starts + size, shape.base)
    return Stretches(
        np.concatenate([lo, starts]),
        np.concatenate([hi, starts]),
        np.concatenate([of, starts_text]),
        np.concatenate([core, mix(alone ^ np.uint64(0xA5A5))]),
        np.concatenate([context, alone]),
        sums,
    )


def single_windows(found: Stretches, which: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretch, start and hash of every window of the stretches at the indices ``which``."""
    counts = found.hi[which] - found.lo[which] + 1
    owner = np.repeat(which, counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = found.lo[owner] + within
    return owner, start, spans_hash(found.sums, start, start + shape.length, shape.base)


def block_count(docs: DataFrame, text: str) -> tuple[int, int]:
    """Blocks for the whole text, and its bytes."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    return max(1, -(-total // BLOCK_BYTES)), total


def blocked(docs: DataFrame, key: str, text: str, n_blocks: int) -> DataFrame:
    """(block, doc_id, text): the block follows from id and text alone, so it is the same whenever computed."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", "text")


def bucket_bits(entries: int) -> int:
    """Leading bits of a hash that name its bucket."""
    return max(1, (max(1, entries) // BUCKET_ENTRIES).bit_length())


def packed(block: int, entries: np.ndarray, bits: int, schema: pa.Schema) -> pa.Table:
    """Rows (bucket, block, entries) of an array whose first column is the hash to deal by."""
    entries = entries[np.lexsort(entries.T[::-1])]
    buckets = (entries[:, 0] >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    parts = np.split(entries, cuts) if len(entries) else []
    firsts = buckets[np.concatenate(([0], cuts))] if len(entries) else []
    return pa.table(
        [
            pa.array(np.asarray(firsts, dtype=np.int32), pa.int32()),
            pa.array([block] * len(parts), pa.int32()),
            pa.array([p.tobytes() for p in parts], pa.binary()),
        ],
        schema=schema,
    )


def packed_phrases(block: int, entries: np.ndarray, bits: int, schema: pa.Schema) -> pa.Table:
    """As :func:`packed`, for sorted entries (core, context, ...); those of cores with many contexts go to buckets of contexts.

    The buckets of contexts are numbered from ``1 << bits`` on.  Equal contexts may
    meet in either kind of bucket, or one in each: then the core has several
    contexts, both are open, and their windows meet one by one.
    """
    core, both = runs(entries[:, 0]), runs(entries[:, 0], entries[:, 1])
    cores = np.flatnonzero(np.diff(core, prepend=-1))
    place = both - both[cores][core]  # of the context within its core
    many = (np.bincount(core, np.diff(both, prepend=-1) != 0) > FEW_CONTEXTS)[core] if len(core) else np.zeros(0, bool)
    by_core = packed(block, entries[~many | (place < FEW_CONTEXTS)], bits, schema)
    spread = entries[many]
    buckets = mix(spread[:, 1]) >> np.uint64(64 - bits)
    order = np.argsort(buckets, kind="stable")
    spread, buckets = spread[order], buckets[order].astype(np.int64) + (1 << bits)
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    parts = np.split(spread, cuts) if len(spread) else []
    firsts = buckets[np.concatenate(([0], cuts))] if len(spread) else []
    by_context = pa.table(
        [
            pa.array(np.asarray(firsts, dtype=np.int32), pa.int32()),
            pa.array([block] * len(parts), pa.int32()),
            pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary()),
        ],
        schema=schema,
    )
    return pa.concat_tables([by_core, by_context])


def of_contexts(table: pa.Table, bits: int) -> bool:
    """Whether the rows of one bucket are entries of cores known to have several contexts."""
    return table.column("bucket")[0].as_py() >= 1 << bits


PACKED = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("entries", pa.binary())])
PACKED_SQL = "bucket int, block int, entries binary"
FLAGS = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("entries", pa.binary())])
FLAGS_SQL = "block int, kind int, entries binary"


def gathered(table: pa.Table, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a bucket and the block of each."""
    blobs = table.column("entries").to_pylist()
    lengths = np.array([len(b) for b in blobs], dtype=np.int64) // (8 * columns)
    entries = np.frombuffer(b"".join(blobs), dtype=np.uint64).reshape(-1, columns)
    return entries, np.repeat(np.array(table.column("block").to_pylist(), dtype=np.int32), lengths)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Index of the run of equal rows each row of sorted columns is in."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def answers(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """Rows (block, kind, entries) from (kind, blocks, entries)."""
    blocks, names, blobs = [], [], []
    for kind, block, entries in parts:
        order = np.argsort(block, kind="stable")
        block, entries = block[order], entries[order]
        cuts = np.flatnonzero(np.diff(block)) + 1
        for piece, own in zip(np.split(entries, cuts), block[np.concatenate(([0], cuts))] if len(block) else []):
            blocks.append(int(own))
            names.append(kind)
            blobs.append(np.ascontiguousarray(piece).tobytes())
    return pa.table([pa.array(blocks, pa.int32()), pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], schema=FLAGS)


def flag_sets(table: pa.Table, columns: int = 1) -> dict[int, np.ndarray]:
    """Entries of each kind, sorted by their first column."""
    found: dict[int, list[bytes]] = {}
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("entries").to_pylist()):
        found.setdefault(kind, []).append(blob)
    out = {}
    for kind, blobs in found.items():
        entries = np.frombuffer(b"".join(blobs), dtype=np.uint64).reshape(-1, columns)
        out[kind] = entries[np.lexsort(entries.T[::-1])]
    return out


def contains(sorted_values: np.ndarray | None, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are among the sorted values."""
    if sorted_values is None or not len(sorted_values):
        return np.zeros(len(wanted), dtype=bool)
    place = np.searchsorted(sorted_values, wanted)
    place[place == len(sorted_values)] = 0
    return sorted_values[place] == wanted


def per_bucket(entries: DataFrame, judge: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return entries.groupBy("bucket").applyInArrow(judge, FLAGS_SQL)


def per_block(texts: DataFrame, flags: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(texts, flags)`` on each block; the shuffle of the texts is the same in every use, so it is run once."""
    return texts.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(work, schema)
