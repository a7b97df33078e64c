"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes sets chunk boundaries; each chunk gives one
character, so an edit changes only the characters near it.  A fingerprint holds
its block size and the signatures at that size, twice and four times it.  Two
fingerprints are compared at every block size they share: by the edit distance
of insertions and deletions, as a share of both lengths, provided the signatures
have a run of characters in common.

Defined results: a null text is an empty one; the fingerprint of an empty text
has empty signatures, is like itself (1) and like no other (0); equal texts have
equal fingerprints and likeness 1; ties of the id are ordered by the text's
hash, null ids come last; an empty table gives no rows.  A sole document is its
own successor.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from lakeworks.llm.arrays import prefix_sums, slices, spans_hash, symbols

WINDOW = 7
#: Most characters of a signature; the block size is the smallest power of two that allows it.
LONGEST = 64
LEVELS = 3
#: Characters two signatures must share in a row to count as alike; half of a shorter one.
COMMON_RUN = 5
#: Text of one ordered slice, and the most slices.
SLICE_BYTES, MOST_SLICES = 8 << 20, 20_000
# fixed values: the characters of a signature
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def fingerprint(text: str | None) -> str:
    """``block size:signature:signature at twice:signature at four times``."""
    data = np.frombuffer((text or "").encode(errors="replace"), dtype=np.uint8)
    n = len(data)
    if n == 0:
        return "1:::"
    sums = prefix_sums(symbols()[data])
    ends = np.arange(1, n + 1)
    rolled = spans_hash(sums, np.maximum(ends - WINDOW, 0), ends)
    # how often a position stays a boundary as the block size doubles
    trailing = np.uint64(0xFFFFFFFFFFFFFFFF) ^ rolled
    lowest = trailing & (~trailing + np.uint64(1))
    size = 1
    while size < 1 << 62 and n > LONGEST and np.count_nonzero((lowest >= size) | (lowest == 0)) >= LONGEST:
        size *= 2
    letters = np.frombuffer(ALPHABET.encode(), dtype=np.uint8)
    signatures = []
    for level in range(LEVELS):
        block = size << level
        last = np.flatnonzero((lowest >= block) | (lowest == 0)) + 1
        if not len(last) or last[-1] != n:
            last = np.append(last, n)
        first = np.concatenate(([0], last[:-1]))
        chosen = (spans_hash(sums, first, last) >> np.uint64(40)) & np.uint64(63)
        signatures.append(letters[chosen.astype(np.int64)].tobytes().decode())
    return ":".join([str(size), *signatures])


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit operation per character of ``b``."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        found = row & places.get(c, 0)
        row = ((row + found) | (row - found)) & full
    return len(a) - row.bit_count()


def _squeeze(signature: str) -> str:
    """Runs of one character cut to three, as they say little."""
    if not any(c * 4 in signature for c in set(signature)):
        return signature
    out: list[str] = []
    for c in signature:
        if out[-3:] != [c, c, c]:
            out.append(c)
    return "".join(out)


def _signature_likeness(a: str, b: str) -> float:
    a, b = _squeeze(a), _squeeze(b)
    if not a or not b:
        return 0.0
    run = min(COMMON_RUN, (min(len(a), len(b)) + 1) // 2)
    grams = {a[k : k + run] for k in range(len(a) - run + 1)}
    if not any(b[k : k + run] in grams for k in range(len(b) - run + 1)):
        return 0.0
    distance = len(a) + len(b) - 2 * _common_subsequence(a, b)
    return 1.0 - distance / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: best likeness of the signatures at block sizes both fingerprints have."""
    if a == b:
        return 1.0
    size_a, *signatures_a = a.split(":")
    size_b, *signatures_b = b.split(":")
    by_size = {int(size_b) << k: s for k, s in enumerate(signatures_b)}
    best = 0.0
    for k, s in enumerate(signatures_a):
        other = by_size.get(int(size_a) << k)
        if other is not None:
            best = max(best, _signature_likeness(s, other))
    return best


@F.pandas_udf(StringType())
def fingerprint_column(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint)


@F.pandas_udf(DoubleType())
def likeness_column(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype="float64")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The input's columns and the fingerprint of each text."""
    return docs.withColumn(name, fingerprint_column(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def _with_successor(rows: DataFrame) -> DataFrame:
    """Adds ``next_text``: the text of the next row by descending id, of the first row after the last.

    The ids are cut into slices at quantiles; each slice is ordered by its own
    task and holds a copy of the first row of the slice after it.
    """
    spark = rows.sparkSession
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n_slices = int(min(max(total // SLICE_BYTES, 1), MOST_SLICES))
    cuts = np.zeros(0, dtype=np.int64)
    if n_slices > 1:
        at = F.array(*[F.lit(k / n_slices) for k in range(1, n_slices)])
        found = rows.agg(F.percentile_approx("id", at, F.lit(20 * n_slices))).first()[0]
        cuts = np.unique(np.array(found or [], dtype=np.int64))

    @F.pandas_udf("int")
    def slice_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(cuts, ids.fillna(0).astype("int64"), side="right")
        return pd.Series(np.where(ids.isna(), -1, place), dtype="int32")

    cut = rows.withColumn("slice", slice_of("id")).withColumn("copy", F.lit(0))
    firsts = sorted(
        (r["slice"], r["key"]["id"], r["key"]["tie"])
        for r in cut.groupBy("slice").agg(F.max(F.struct("id", "tie")).alias("key")).collect()
    )[::-1]
    targets = [firsts[k - 1][0] for k in range(len(firsts))]
    moves = [(i, tie, s, to) for (s, i, tie), to in zip(firsts, targets)]
    moves = spark.createDataFrame(moves, "id long, tie long, slice int, target int")
    copies = (
        cut.join(
            F.broadcast(moves.withColumnsRenamed({"id": "m_id", "tie": "m_tie", "slice": "m_slice"})),
            (F.col("slice") == F.col("m_slice")) & F.col("id").eqNullSafe(F.col("m_id")) & (F.col("tie") == F.col("m_tie")),
        )
        .select("id", "text", "tie", F.col("target").alias("slice"), F.lit(1).alias("copy"))
        .dropDuplicates(["slice"])
    )
    order = Window.partitionBy("slice").orderBy("copy", F.desc_nulls_last("id"), F.desc("tie"))
    return (
        cut.unionByName(copies)
        .withColumn("next_text", F.lead("text").over(order))
        .filter("copy = 0")
        .select("id", "text", "next_text")
    )


def against_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edit replaces the last half of the characters by the beginning of the
    next document.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    content: Column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), content.alias("text"))
    rows = _with_successor(rows.withColumn("tie", F.xxhash64("text")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = lru_cache(maxsize=2)(fingerprint)  # the next row's text was this row's successor
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in fields}
            for i, own, following in zip(*(batch.column(k).to_pylist() for k in range(3))):
                half = len(own) // 2
                edited = own[: len(own) - half] + following[:half]
                mine, theirs = remembered(own), remembered(following)
                changed = fingerprint(edited)
                row = (i, len(own), hashlib.sha256(edited.encode()).hexdigest(), mine, changed)
                for name, value in zip(fields, (*row, likeness(mine, changed), likeness(mine, theirs))):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in fields.items()], names=list(fields))

    fields = {
        "doc_id": pa.int64(),
        "n_chars": pa.int64(),
        "edited_sha256": pa.string(),
        "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
    }
    return rows.mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
