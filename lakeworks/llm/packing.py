"""Best-fit packing of token sequences by bulk-synchronous rounds.

Documents are tokenised and cut into pieces; pieces and gaps are then matched in
rounds.  In a round both are in order of length, a sweep gives every gap the
longest piece that fits (its predecessor in the other order), ties are settled
by rank, the gaps shrink, and the next round starts.  Pieces of equal length are
interchangeable and so are equal gaps, so a round sweeps runs of equal lengths
and not single rows: its state is at most ``capacity`` run lengths, whatever the
number of documents.  The rounds yield a plan of rank ranges, and one
distributed join on (length, rank) puts every piece in its place.

Defined results: a null text is an empty one, which is its closing id alone;
repeated rows are pieces of their own, told apart by rank; an empty table gives
no rows.  Only the id and text columns are read.  A null id is kept as null.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeworks.llm.arrays import trim
from lakeworks.llm.wordids import row_runs
from lakeworks.session import cut_lineage

CAPACITY = 1024
CLOSING_ID = 2
#: Rows of one length that are ranked together, and the most groups a length is dealt into.
RANK_ROWS, RANK_GROUPS = 1000, 10_000
#: Distinct space-separated chunks whose ids a worker remembers, and bytes of text encoded together.
MEMO, SLICE_BYTES = 500_000, 1 << 20
#: A blank after any white space, or the beginning of a marker.
ODD = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] |<\|"


def _encoder(model: str):
    """One text to its little-endian 32-bit ids."""
    column = _column_encoder(model)
    return lambda text: column(pa.array([text], pa.string()))[0].tobytes()


def _column_encoder(model: str):
    """Texts to 32-bit ids: all ids of a text column, and the first id of each text (one more at the end).

    A blank after a non-blank always starts a new unit of this vocabulary's
    splitting pattern, so the chunks between blanks are encoded one by one: each
    distinct one of a column once, remembered for the next.  Texts with a blank
    after white space, or with the closing marker written out, are encoded as a
    whole.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    ranks_file = model.removesuffix(".json") + ".tiktoken"
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(model)
    memo: dict[str, bytes] = {}

    def chunk(text: str) -> bytes:
        if len(memo) > MEMO:
            memo.clear()
        ids = memo[text] = np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()
        return ids

    def by_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        offsets = np.asarray(lists.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        coded = pc.dictionary_encode(lists.flatten())
        code = np.asarray(coded.indices).astype(np.int64) * 2 + 1  # odd: behind a blank
        code[offsets[:-1]] -= 1
        distinct, inverse = np.unique(code, return_inverse=True)
        words = coded.dictionary.take(pa.array(distinct >> 1)).to_pylist()
        words = [f" {w}" if k else w for w, k in zip(words, (distinct & 1).tolist())]
        encoded = [memo.get(w) or chunk(w) for w in words]
        pool = np.frombuffer(b"".join(encoded), dtype="<u4")
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        starts, n = np.cumsum(sizes) - sizes, sizes[inverse]
        before = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=before[1:])
        ids = pool[np.repeat(starts[inverse] - before[:-1], n) + np.arange(before[-1])]
        return ids, before[offsets]

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = np.asarray(pc.or_(pc.match_substring_regex(texts, ODD), pc.starts_with(texts, " ")))
        if not odd.any():
            return by_chunks(texts)
        ids, ends = by_chunks(pc.if_else(pa.array(odd), "", texts))
        places = np.flatnonzero(odd)
        others = {k: np.array(whole.encode(texts[k].as_py(), add_special_tokens=False).ids, dtype="<u4") for k in places.tolist()}
        parts = [others[k] if k in others else ids[ends[k] : ends[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))

    return encode


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; only the first may be shorter than ``capacity``."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first), *((k, capacity) for k in range(first, n, capacity))]


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    model: str | None = None,
    capacity: int = CAPACITY,
    closing: int = CLOSING_ID,
) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids_crc32."""
    model = model or default_model()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    end = np.array([closing], dtype="<u4").tobytes()
    slice_bytes = SLICE_BYTES

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _column_encoder(model)
        for batch in batches:
            for first, last in row_runs(batch.column(1), slice_bytes):
                yield cut_texts(encode, batch.slice(first, last - first))
        del encode  # before memory is given back, as the worker is used again
        trim()

    def cut_texts(encode: Callable, batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        ids_of_all, starts = encode(pc.fill_null(batch.column(1), ""))
        for k, a, z in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
            ids = ids_of_all[a:z].tobytes() + end
            for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                out.append((k, number, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return rows.mapInArrow(tokenise, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sweep_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rank ranges of pieces and the sequences they go to.

    ``counts`` is the number of pieces of each length.  Returns ranges (length,
    first rank, end rank, first sequence, offset): the piece of that length with
    rank ``r`` goes to sequence ``first sequence + r - first rank``.

    The rounds go on until nothing is left.  Each opens one sequence for the
    longest pieces if no gap takes a piece any more, else fills gaps: runs of
    gaps in ascending order each get the longest run of pieces that fits.
    """
    left = {n: c for n, c in counts.items() if c}
    ranks = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, end)
    plan: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, run: tuple[int, int], gap: int) -> None:
        n = run[1] - run[0]
        plan.append((length, ranks[length], ranks[length] + n, run[0], capacity - gap))
        ranks[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    while left:
        moved: dict[int, list[tuple[int, int]]] = {}
        lengths = sorted(left)
        any_placed = False
        for gap in sorted(gaps):
            rest = []
            for run in gaps[gap]:
                first, end = run
                while first < end and (at := bisect_right(lengths, gap)):
                    length = lengths[at - 1]
                    if length not in left:
                        lengths.pop(at - 1)
                        continue
                    n = min(end - first, left[length])
                    place(length, (first, first + n), gap)
                    moved.setdefault(gap - length, []).append((first, first + n))
                    first += n
                    any_placed = True
                if first < end:
                    rest.append((first, end))
            gaps[gap] = rest
        if not any_placed:
            longest = max(left)
            n = left[longest]
            if longest <= capacity // 2:  # several of them share a sequence
                n = -(-n // (capacity // longest))
            run = (opened, opened + n)
            opened += n
            place(longest, run, capacity)
            moved.setdefault(capacity - longest, []).append(run)
        smallest = min(left, default=capacity + 1)
        for gap, runs in moved.items():
            gaps.setdefault(gap, []).extend(runs)
        gaps = {gap: runs for gap, runs in gaps.items() if runs and gap >= smallest}
    return plan


def ranked(items: DataFrame, order: list[str], rows_per_group: int = RANK_ROWS) -> DataFrame:
    """Adds ``rank``, a number from 0 without gaps within each length.

    A length may hold most rows, so it is dealt into groups that are numbered
    alone and moved by the counts of the groups before them.
    """
    largest = items.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    groups = min(max(1, largest // rows_per_group), RANK_GROUPS)
    dealt = items.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "_group")
        .count()
        .select("length", "_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    inner = Window.partitionBy("length", "_group").orderBy(*order)
    return (
        dealt.withColumn("_inner", F.row_number().over(inner) - 1)
        .join(offsets, ["length", "_group"])
        .withColumn("rank", F.col("_inner") + F.col("_before"))
        .drop("_group", "_inner", "_before")
    )


def plan_table(spark: SparkSession, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan by length: arrays of first ranks and what goes with them."""
    by_length: dict[int, list] = {}
    for length, first, _, sequence, offset in sorted(plan):
        by_length.setdefault(length, []).append((first, sequence, offset))
    rows = [(length, runs) for length, runs in by_length.items()]
    kind = "length long, runs array<struct<first: long, sequence: long, offset: long>>"
    return spark.createDataFrame(rows, kind)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    The pieces are written once, as they are counted, ranked and placed.  Only
    the count of each length comes to the driver, at most ``capacity`` numbers,
    and the plan goes back as one broadcast row a length.
    """
    spark = items.sparkSession
    items = cut_lineage(items, "pieces")
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}
    plan = sweep_rounds(counts, capacity)
    # the last run whose first rank is not above the piece's rank
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return (
        ranked(items, ["doc_id", "piece", "start", "ids_crc32"])
        .join(F.broadcast(plan_table(spark, plan)), "length")
        .withColumn("_run", run)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_run.sequence") + F.col("rank") - F.col("_run.first")).alias("sequence_id"),
            F.col("_run.offset").alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise, cut and pack: one row per piece."""
    return pack(pieces(docs, key, text, model, capacity), capacity)
