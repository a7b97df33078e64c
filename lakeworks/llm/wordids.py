"""Words of a text column as numbers, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of the words of all texts, the first word of each text (one more at the end), the distinct words.

    Words are maximal runs without blank, tab, and line and page breaks.  Null
    counts as empty.  The numbers follow first occurrence, so equal inputs give
    equal numbers.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets).astype(np.int64)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    real = np.asarray(pc.not_equal(flat, "")) if len(flat) else np.zeros(0, bool)
    if not real.all():
        flat = flat.filter(pa.array(real))
        before = np.zeros(len(real) + 1, np.int64)
        np.cumsum(real, out=before[1:])
        offsets = before[offsets]
    coded = pc.dictionary_encode(flat)
    return np.asarray(coded.indices).astype(np.int64), offsets, coded.dictionary


def row_runs(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about ``most`` bytes together; a longer text is a run of its own."""
    n = len(texts)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not n:
        return
    # read in place: a copy of the column would cost as much memory as all its texts
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
