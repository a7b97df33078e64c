"""Texts as byte arrays: slices of a batch, words, and rolling hashes, all vectorised.

Hashes are polynomials modulo 2**64 over random symbol values, taken from prefix
sums, so that any substring's hash costs one subtraction and two multiplications.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD1342543DE82EF95 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_SYMBOLS: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def symbols() -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    if 0 not in _SYMBOLS:
        _SYMBOLS[0] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _SYMBOLS[0]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        size = max(n + 1, 1 << 20)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _POWERS[base]


def prefix_sums(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix hash of a symbol sequence; one longer than the sequence."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values))[0][: len(values)], dtype=np.uint64, out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each half-open range of the sequence behind ``sums``."""
    return mix((sums[end] - sums[start]) * powers(base, len(sums))[1][start])


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole texts of about ``most`` bytes.

    Yields the first row, the bytes, and the offsets of the texts in them; a
    text longer than ``most`` is a run of its own.  Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that few texts are Python objects at a time; freed memory goes back at the end.

    Workers outlive their tasks, and what they keep counts against their executor.
    """
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    trim()


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release:
        release(0)


def space_table() -> np.ndarray:
    """True for the bytes that separate words: blank, tab, and the line and page breaks."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of each text (one more at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space_table()[data]
    inner = offsets[(offsets > 0) & (offsets < n)]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[inner] = inside[inner]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[inner - 1] = inside[inner - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: their length, then eight bytes at a time, each step mixed.

    Polynomials modulo 2**64 have words of regular structure that collide under
    any base; these do not.
    """
    # every place of the data as the first of eight bytes, read in place
    eights = np.lib.stride_tricks.as_strided(np.append(data, np.zeros(8, np.uint8)).view(np.uint8), (len(data) + 1, 8), (1, 1))
    left = ends - starts
    hashes = mix(left.astype(np.uint64))
    at, rows = starts, np.flatnonzero(left > 0)
    at, left = at[rows], left[rows]
    while len(rows):
        value = eights[at].view(np.uint64).ravel()
        spare = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        value = (value << spare) >> spare
        hashes[rows] = mix(hashes[rows] + value * np.uint64(BASE))
        long = left > 8
        rows, at, left = rows[long], at[long] + 8, left[long] - 8
    return hashes
