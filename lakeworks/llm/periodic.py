"""Periodic runs of words, found with longest common extensions over a difference cover.

The texts of a slice are one sequence of word numbers with a separator of its own
before and after every text.  Only suffixes that start in a difference cover
modulo 13 are sorted (by packed words, then by doubling among the samples); the
common prefix of neighbours feeds a sparse table.  The common extension of any two
places compares fewer than 13 words until both are sampled and looks up the rest.
A second table over the reversed sequence extends to the left.

Runs are enumerated on a harmonic grid: a run of period ``q`` and exponent ``e``
holds ``(e - 1) * q`` places in a row whose word comes again ``q`` words later, so
one of every ``(e - 1) * q`` places is tried, n log n in all, whatever repeats.

Documents are independent, so the work is one pass without a shuffle; a task
holds one slice of texts, and a text longer than a slice alone.

Defined results: a null or empty text has no words and no runs; repeated rows are
rows of their own; texts of one repeated word are one run; an empty table gives
no rows.  A null id is kept as null.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import trim
from lakeworks.llm.wordids import row_runs, word_ids

#: Every difference modulo the period occurs between two members of the cover.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Bytes of text of one slice, and grid places that are tried together.
SLICE_BYTES, GRID_PLACES = 1 << 20, 1 << 20
LEAST_WORDS, LEAST_EXPONENT = 6, 4

SCHEMA = "key long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _steps() -> np.ndarray:
    """Words until two places with these remainders are both in the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    t = np.arange(PERIOD)
    both = inside[(t[:, None, None] + t) % PERIOD] & inside[(t[None, :, None] + t) % PERIOD]
    return both.argmax(axis=2)


def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split groups of equal rank by ``key``; a rank is the first place of its group.  Returns what is still tied."""
    order = np.lexsort((key, rank[tied]))
    tied, key = tied[order], key[order]
    old = rank[tied]
    place = np.arange(len(tied))
    group = np.ones(len(tied), bool)
    group[1:] = old[1:] != old[:-1]
    part = group.copy()
    part[1:] |= key[1:] != key[:-1]
    rank[tied] = old + np.maximum.accumulate(np.where(part, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
    alone = part & np.append(part[1:], True)
    return tied[~alone]


class Extensions:
    """Longest common extensions to the right in a sequence whose suffixes all differ before they end."""

    def __init__(self, sequence: np.ndarray):
        n = len(sequence)
        self.steps = _steps()
        self.words = np.append(sequence + 1, np.zeros(2 * PERIOD, np.int64))
        inside = np.zeros(PERIOD, bool)
        inside[list(COVER)] = True
        places = np.flatnonzero(np.resize(inside, n))
        m = len(places)
        self.sample = np.full(n + 1, m, dtype=np.int64)
        self.sample[places] = np.arange(m)
        rank = np.zeros(m + 1, dtype=np.int64)
        rank[m] = -1
        tied = np.arange(m)
        bits = max(1, int(self.words.max()).bit_length())
        packed = max(1, 63 // bits)
        for first in range(0, PERIOD, packed):
            if not len(tied):
                break
            key = np.zeros(len(tied), dtype=np.int64)
            for t in range(first, min(first + packed, PERIOD)):
                key = (key << bits) | self.words[places[tied] + t]
            tied = _refine(rank, tied, key)
        # rank after 13, 26, 52 ... words
        levels, reach = [rank.copy()], PERIOD
        while len(tied):
            tied = _refine(rank, tied, rank[self.sample[np.minimum(places[tied] + reach, n)]])
            levels.append(rank.copy())
            reach *= 2
        self.rank = rank
        order = np.empty(m, dtype=np.int64)
        order[rank[:m]] = np.arange(m)
        self.table = self._sparse(self._neighbours(places[order], levels, n))

    def _neighbours(self, places: np.ndarray, levels: list[np.ndarray], n: int) -> np.ndarray:
        """Common prefix of each sorted sample with the one before it."""
        a, b = places[:-1], places[1:]
        common = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = self.sample[np.minimum(a + common, n)], self.sample[np.minimum(b + common, n)]
            common += np.where(levels[k][i] == levels[k][j], PERIOD << k, 0)
        open_ = np.arange(len(a))
        for _ in range(PERIOD):
            at = common[open_]
            open_ = open_[self.words[a[open_] + at] == self.words[b[open_] + at]]
            common[open_] += 1
        return common

    @staticmethod
    def _sparse(values: np.ndarray) -> np.ndarray:
        """Minima of 1, 2, 4 ... values from each place on."""
        rows = max(1, len(values).bit_length())
        table = np.zeros((rows, max(1, len(values))), dtype=np.int32)
        table[0, : len(values)] = values
        for k in range(1, rows):
            half = 1 << (k - 1)
            width = len(values) - 2 * half + 1
            table[k, :width] = np.minimum(table[k - 1, :width], table[k - 1, half : half + width])
        return table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` and from ``j`` on that are the same; ``i`` and ``j`` differ."""
        out = np.zeros(len(i), dtype=np.int64)
        steps = self.steps[i % PERIOD, j % PERIOD]
        open_ = np.arange(len(i))
        for t in range(PERIOD):
            synced = steps[open_] == t
            done, open_ = open_[synced], open_[~synced]
            if len(done):
                out[done] = t + self._sampled(i[done] + t, j[done] + t)
            if not len(open_):
                break
            same = self.words[i[open_] + t] == self.words[j[open_] + t]
            out[open_[~same]] = t
            open_ = open_[same]
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[self.sample[i]], self.rank[self.sample[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.table[k, low], self.table[k, high - (1 << k)])


def runs_of(
    ids: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and smallest period of every run, by text, start and period."""
    sizes = np.diff(offsets)
    n_texts, e = len(sizes), least_exponent
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    most = np.where(sizes >= least_words, sizes // e, 0)
    if not most.any():
        return none
    first = offsets[:-1] + np.arange(n_texts) + 1
    sequence = np.empty(len(ids) + n_texts + 1, dtype=np.int64)
    marks = np.append(first - 1, len(sequence) - 1)
    own = np.ones(len(sequence), bool)
    own[marks] = False
    sequence[own] = ids
    sequence[marks] = (ids.max() + 1) + np.arange(n_texts + 1)
    right = left = None

    text = np.repeat(np.arange(n_texts), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    least = np.maximum(least_words, e * period)
    step = least - period
    tries = -(-(sizes[text] - period) // step)
    ends = np.cumsum(tries)
    found = []
    done = 0
    while done < len(text):
        upto = int(np.searchsorted(ends, (ends[done - 1] if done else 0) + GRID_PLACES, side="right"))
        upto = max(upto, done + 1)
        many = tries[done:upto]
        pair = np.repeat(np.arange(done, upto), many)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        x = first[text[pair]] + nth * step[pair]
        same = sequence[x] == sequence[x + period[pair]]
        x, pair = x[same], pair[same]
        if len(x):
            if right is None:
                right, left = Extensions(sequence), Extensions(sequence[::-1].copy())
            q = period[pair]
            ahead = right.common(x, x + q)
            back = left.common(len(sequence) - x, len(sequence) - x - q)
            length = ahead + back + q
            long = length >= least[pair]
            t = text[pair[long]]
            found.append(np.stack([t, x[long] - back[long] - first[t], length[long], q[long]]))
        done = upto
    if not found:
        return none
    t, start, length, q = np.concatenate(found, axis=1)
    # a stretch that a multiple of its period finds again is the same run
    order = np.lexsort((q, length, start, t))
    t, start, length, q = t[order], start[order], length[order], q[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    t, start, length, q = t[new], start[new], length[new], q[new]
    order = np.lexsort((q, start, t))
    return t[order], start[order], length[order], q[order]


def _collapsed(ids: np.ndarray, offsets: np.ndarray, words: pa.Array, dropped: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one blank."""
    before = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(~dropped, out=before[1:])
    kept = words.take(pa.array(ids[~dropped])) if len(ids) else pa.array([], pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(before[offsets].astype(np.int32)), kept.cast(pa.string())), " ")


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str | Column = "text",
    least_words: int = LEAST_WORDS,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """Runs of every text and the text with each run cut down to its first period.

    A run is a stretch of words with smallest period ``q`` and at least
    ``max(least_words, least_exponent * q)`` words that no neighbouring word
    extends.  ``collapsed`` leaves out a word if any run holds it after that run's
    first ``q`` words.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in row_runs(batch.column(1), SLICE_BYTES):
                ids, offsets, words = word_ids(batch.column(1).slice(first, last - first))
                t, start, length, period = runs_of(ids, offsets, least_words, least_exponent)
                change = np.zeros(len(ids) + 1, np.int64)
                np.add.at(change, offsets[t] + start + period, 1)
                np.add.at(change, offsets[t] + start + length, -1)
                dropped = np.cumsum(change[:-1]) > 0
                each = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(t, np.arange(last - first + 1)).astype(np.int32)), each)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(offsets)),
                        lists,
                        _collapsed(ids, offsets, words, dropped),
                    ],
                    names=["key", "n_words", "runs", "collapsed"],
                )
        trim()

    return rows.mapInArrow(search, SCHEMA).withColumnRenamed("key", key)


def longest(runs: Column) -> Column:
    """The longest run, of several the first, then the one of the smallest period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(
        F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))
    )


def runs_text(runs: Column) -> Column:
    """One line ``start,length,period`` for each run."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
