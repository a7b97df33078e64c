"""Interpolated modified Kneser-Ney language model, counted and asked in Spark.

A text is a begin mark, its words in lower case (A-Z only), and an end mark that
is a token too.  A word's key is a 64-bit hash of its bytes; an n-gram's key mixes
the keys of its first and its last n - 1 words, so every n-gram knows its context
and its suffix.

*Counting.*  A task counts the distinct n-grams of a block of documents and sends
them, packed and split by key, to shards.  A shard adds them up and writes one file
of sorted keys and counts.  It also adds up, by context, how many successors were
seen once, twice and more often, and by suffix, how many n-grams end in it; these
sums go to the shards of the next lower order, whose counts they are.  Counts of
counts give three discounts for each order.

*Scoring.*  A block's distinct n-grams are sent to the shards, which map their
files into memory and answer from the sorted arrays; the answers of a block are one
file, mapped by the task that scores the block.  So no task reads more of the model
than the part its n-grams fall into, whatever the size of the corpus, and frequent
n-grams count once a block.

Every text is counted and scored whole; no n-gram is pruned.

Blocks are cut from the partitions of the documents' scan, which is read again for
scoring.  Documents that come out of a shuffle are written first, and an answer
that does not fit its block fails the job.

Defined results: null and empty texts are the end mark alone; repeated rows count
and are scored each; without training documents every probability is 1; an empty
table gives no rows.  Other columns are not read.  Sums of probabilities use 32-bit
factors: a score is right to about one part in ten million.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm import shared_arrays
from lakeworks.llm.arrays import mix, trim, word_hashes
from lakeworks.llm.wordids import row_runs, word_ids
from lakeworks.session import cut_lineage, free_shuffles, remove_scratch, scratch_path

ORDER = 2
#: Counts below this are one byte in a file.
WIDE = 255
#: Tokens of a block, text bytes that are split at a time, tokens that a shard stands for.
BLOCK_TOKENS, SLICE_BYTES, SHARD_TOKENS = 700_000, 1 << 19, 1_000_000
#: Bytes of text for a token, to choose the number of shards; it bears on no result.
TOKEN_BYTES = 6
#: Discounts where the counts of counts have gaps (small corpora).
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)
#: Keys of the marks.  Only n-grams that begin with the begin mark have odd keys.
BEGIN, END = 1, 2

PACKED = "shard long, keys binary, context binary, suffix binary, n binary, sums binary"


@dataclass(frozen=True)
class Model:
    """Where the shards are, and what holds for all of them."""

    folder: str
    order: int
    bits: int
    train_tokens: int
    vocabulary: int
    #: Discounts of each order, from 1 up.
    discounts: tuple[tuple[float, float, float], ...]
    #: Sum of the counts of order 1, and the share they leave to unknown words.
    total: float
    rest: float


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte plane by byte plane, which compress."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def pack(values: np.ndarray) -> bytes:
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()


def unpack(data: bytes | pa.Buffer, kind: str = "<u8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def unpack_sorted(data: bytes | pa.Buffer) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order."""
    keys = np.sort(keys)
    return keys[_starts(keys)]


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Places where a new value starts."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def word_keys(words: pa.Array) -> np.ndarray:
    """Even 64-bit hashes of words."""
    words = words.cast(pa.large_binary())
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    keys = word_hashes(data, offsets[:-1], offsets[1:]) & ~np.uint64(1)
    return np.where(keys <= END, keys + np.uint64(4), keys)


def joined_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of the n-gram with this context and suffix; odd if the context is."""
    return (mix(mix(context) + suffix) & ~np.uint64(1)) | (context & np.uint64(1))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens with both marks, and the number of tokens of each text."""
    ids, offsets, words = word_ids(pc.ascii_lower(texts))
    sizes = np.diff(offsets) + 2
    starts = np.cumsum(sizes) - sizes
    keys = np.empty(int(sizes.sum()), dtype=np.uint64)
    inner = np.ones(len(keys), bool)
    inner[starts] = inner[starts + sizes - 1] = False
    keys[starts], keys[starts + sizes - 1] = BEGIN, END
    keys[inner] = word_keys(words)[ids] if len(ids) else []
    return keys, sizes


def blocks(batches: Iterator[pa.RecordBatch], text: int, block_tokens: int) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray]]:
    """Number, rows without their text, token keys and sizes of each block of a partition."""
    number, held, rows, keys, sizes = 0, 0, [], [], []
    for batch in batches:
        for first, last in row_runs(batch.column(text), SLICE_BYTES):
            part = batch.slice(first, last - first)
            k, s = tokens_of(part.column(text))
            rows.append(pa.table({f.name: c for i, (f, c) in enumerate(zip(part.schema, part.columns)) if i != text}))
            keys.append(k)
            sizes.append(s)
            held += len(k)
            if held >= block_tokens:
                yield number, pa.concat_tables(rows), np.concatenate(keys), np.concatenate(sizes)
                number, held, rows, keys, sizes = number + 1, 0, [], [], []
            del part
        del batch  # before the next one is read, not after
    if rows:
        yield number, pa.concat_tables(rows), np.concatenate(keys), np.concatenate(sizes)
    trim()


def positions(sizes: np.ndarray) -> np.ndarray:
    """Place of every token in its text."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def order_keys(keys: np.ndarray, order: int) -> np.ndarray:
    """Key of the n-gram that ends at every token; those that reach over the start of a text mean nothing."""
    for _ in range(order - 1):
        keys = np.append(keys[:1], joined_keys(keys[:-1], keys[1:]))
    return keys


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _split(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Shards of ascending keys, and the part of each."""
    shards = shard_of(keys, bits)
    starts = _starts(shards)
    for a, z in zip(starts, [*starts[1:], len(keys)]):
        yield int(shards[a]), slice(int(a), int(z))


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


PACKED_ARROW = pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("keys", "context", "suffix", "n", "sums"))])


def _counted(order: int, bits: int, block_tokens: int) -> Callable:
    """Counts of the distinct n-grams of each block, by shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, words, sizes in blocks(batches, 0, block_tokens):
            place = positions(sizes)
            real = place >= max(order - 1, 1)
            if order == 1:
                keys = np.sort(words[real])
                starts = _starts(keys)
                keys, n = keys[starts], np.diff(starts, append=len(keys))
                out = [{"shard": s, "keys": pack_sorted(keys[p]), "n": pack(n[p].astype("<u4"))} for s, p in _split(keys, bits)]
            else:
                lower = order_keys(words, order - 1)
                context, suffix = lower[:-1][real[1:]], lower[1:][real[1:]]
                keys = joined_keys(context, suffix)
                by = np.argsort(keys)
                keys = keys[by]
                starts = _starts(keys)
                keys, first, n = keys[starts], by[starts], np.diff(starts, append=len(keys))
                out = []
                for s, p in _split(keys, bits):
                    c, f = context[first[p]], suffix[first[p]]
                    # most halves occur in several n-grams: they are listed once and numbered
                    halves, at = np.unique(np.append(c, f), return_inverse=True)
                    c, f = at[: len(c)], at[len(c) :]
                    by = np.argsort(c, kind="stable")
                    steps = np.diff(c[by], prepend=0).astype("<u4")
                    out.append({"shard": s, "keys": pack_sorted(halves), "context": pack(steps), "suffix": pack(f[by].astype("<u4")), "n": pack(n[p][by].astype("<u4"))})
            yield _rows(out, PACKED_ARROW)

    return count


def _added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order with the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = _starts(keys)
    return keys[starts], *((np.add.reduceat(v[order], starts) if len(keys) else v[:0]) for v in values), order[starts]


#: Sums that go to the next lower order: total, successors seen once, twice, more often, and n-grams that end here.
SUMS = 5


def _summed(order: int, top: int, bits: int, folder: str) -> Callable:
    """One shard: writes its sorted arrays, returns the sums of the lower order and the counts of counts."""
    schema = pa.schema([*PACKED_ARROW, ("tally", pa.list_(pa.int64()))])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        columns = {c: [v.as_buffer() for v in table.column(c)] for c in ("keys", "context", "suffix", "n", "sums")}
        some = lambda parts, kind=np.uint64: np.concatenate(parts) if parts else np.zeros(0, kind)
        counted = [k for k, n in enumerate(columns["n"]) if n is not None]
        raw = some([unpack(columns["n"][k], "<u4").astype(np.int64) for k in counted], np.int64)
        if order > 1:
            halves = [unpack_sorted(columns["keys"][k]) for k in counted]
            context = some([h[np.cumsum(unpack(columns["context"][k], "<u4"))] for k, h in zip(counted, halves)])
            suffix = some([h[unpack(columns["suffix"][k], "<u4")] for k, h in zip(counted, halves)])
            del halves
            keys, raw, first = _added(joined_keys(context, suffix), raw)
            context, suffix = context[first], suffix[first]
        else:
            keys, raw, first = _added(some([unpack_sorted(columns["keys"][k]) for k in counted]), raw)
        count, arrays = raw, {}
        if order < top:
            summed = [k for k, s in enumerate(columns["sums"]) if s is not None]
            sums = [unpack(columns["sums"][k], "<u8").astype(np.int64).reshape(SUMS, -1) for k in summed]
            sums = np.concatenate(sums, axis=1) if sums else np.zeros((SUMS, 0), np.int64)
            below, *sums, _ = _added(some([unpack_sorted(columns["keys"][k]) for k in summed]), *sums)
            every = distinct(np.append(keys, below))
            at, from_below = np.searchsorted(every, keys), np.searchsorted(every, below)
            widen = lambda values, places: np.bincount(places, values, len(every)).astype(np.int64)
            raw, sums = widen(raw, at), [widen(s, from_below) for s in sums]
            if order > 1:
                # every key below is an n-gram that was counted here, as contexts and suffixes are
                if len(every) != len(keys):
                    raise ValueError("an n-gram has contexts or suffixes that were not counted")
            keys = every
            begins = (keys & np.uint64(1)).astype(bool)
            count = np.where(begins & (keys != BEGIN), raw, sums[4])
            arrays = dict(zip(("total", "once", "twice", "more"), (s.astype("<f4" if k == 0 else "<u4") for k, s in enumerate(sums[:4]))))
        arrays = {"keys": keys.astype("<u8"), **narrow(count), **arrays}
        if order == 1:
            arrays["raw"] = raw.astype("<i8")
        shared_arrays.save(folder, f"{order}-{key[0].as_py()}", arrays)
        tally = [int((count == k).sum()) for k in (1, 2, 3, 4)] + [int((count > 2).sum()), int(count.sum()), int(raw.sum()), int((raw > 0).sum())]
        out = [{"shard": None, "tally": tally}]
        if order > 1:
            one = np.ones(len(keys), np.int64)
            none = np.zeros(len(keys), np.int64)
            by_context = _added(context, count, *((count == k).astype(np.int64) for k in (1, 2)), (count > 2).astype(np.int64))[:-1]
            by_suffix = _added(suffix, one)[:-1]
            both = np.append(by_context[0], by_suffix[0])
            sums = [np.append(c, none[: len(by_suffix[0])]) for c in by_context[1:]] + [np.append(none[: len(by_context[0])], by_suffix[1])]
            both, *sums, _ = _added(both, *sums)
            for s, p in _split(both, bits):
                out.append({"shard": s, "keys": pack_sorted(both[p]), "sums": pack(np.stack([v[p] for v in sums]).astype("<u8").ravel())})
        found = pa.Table.from_batches([_rows(out, schema)])
        del columns, out, arrays
        trim()
        return found

    return add


def discounts_of(tally: list[int]) -> tuple[float, float, float]:
    """The three discounts from the number of n-grams seen once to four times."""
    one, two, three, four = tally[:4]
    if not (one and two and three and four):
        return PLAIN_DISCOUNTS
    share = one / (one + 2 * two)
    found = (1 - 2 * share * two / one, 2 - 3 * share * three / two, 3 - 4 * share * four / three)
    return found if all(0 < d < k + 1 for k, d in enumerate(found)) else PLAIN_DISCOUNTS


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, and its path; the shuffles behind them are given up."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path), path


def narrow(count: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in one byte each; the places and values of those that do not fit follow."""
    wide = np.flatnonzero(count >= WIDE)
    return {"count": np.minimum(count, WIDE).astype("u1"), "wide_at": wide.astype("<i8"), "wide": count[wide].astype("<i8")}


def widened(arrays: dict[str, np.ndarray], at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Counts at some places."""
    count = arrays["count"][at].astype(np.int64)
    if len(arrays["wide"]):
        places = np.arange(len(arrays["count"])) if isinstance(at, slice) else at
        big = np.flatnonzero(count == WIDE)
        count[big] = arrays["wide"][np.searchsorted(arrays["wide_at"], places[big])]
    return count


def fit(docs: DataFrame, text: str | Column = "text", order: int = ORDER, block_tokens: int | None = None) -> Model:
    """A model of all texts; its shards are files below the shared folder."""
    if order < 2:
        raise ValueError("an order of 2 or more")
    block_tokens = block_tokens or BLOCK_TOKENS
    spark = docs.sparkSession
    texts = docs.select((F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))
    size = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + TOKEN_BYTES)).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / TOKEN_BYTES / SHARD_TOKENS))))
    folder = scratch_path(spark, "model")
    tallies: dict[int, list[int]] = {}
    sums = done = None
    for level in range(order, 0, -1):
        rows = texts.mapInArrow(_counted(level, bits, block_tokens), PACKED)
        if sums is not None:
            rows = rows.unionByName(sums)
        found = rows.groupBy("shard").applyInArrow(_summed(level, order, bits, folder), PACKED + ", tally array<long>")
        found, path = _written(found, f"counts-{level}")
        if done:
            remove_scratch(spark, done)
        done = path
        each = [F.sum(F.col("tally")[k]).alias(str(k)) for k in range(8)]
        tallies[level] = [n or 0 for n in found.filter("tally IS NOT NULL").agg(*each).first()]
        sums = found.filter("tally IS NULL").drop("tally")
    remove_scratch(spark, done)
    words = tallies[1]
    discounts = tuple(discounts_of(tallies[k]) for k in range(1, order + 1))
    d, total = discounts[0], words[5]
    rest = (d[0] * words[0] + d[1] * words[1] + d[2] * words[4]) / total if total else 1.0
    return Model(folder, order, bits, words[6], words[7], discounts, float(total), rest)


def discounted(count: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    table = np.array([0.0, *discounts])
    return np.maximum(count - table[np.minimum(count, 3).astype(np.int64)], 0.0)


#: What an answer holds for each n-gram, by kind of order.
TOP_FIELDS, LOWER_FIELDS, WORD_FIELDS = ("count",), ("count", "total", "rest"), ("count", "total", "rest", "raw")
KINDS = {"count": "<i8", "total": "<f4", "rest": "<f4", "raw": "<i8"}


def _fields(level: int, order: int) -> tuple[str, ...]:
    return TOP_FIELDS if level == order else WORD_FIELDS if level == 1 else LOWER_FIELDS


def _levels(keys: np.ndarray, place: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order the tokens at which an n-gram ends, and its keys there."""
    for level in range(1, order + 1):
        if level > 1:
            keys = np.append(keys[:1], joined_keys(keys[:-1], keys[1:]))
        ends = np.flatnonzero(place >= level - 1)
        yield level, ends, keys[ends]


ASKED = pa.schema([("block", pa.int64()), ("level", pa.int64()), ("shard", pa.int64()), ("keys", pa.binary())])


def _asked(model: dict, block_tokens: int) -> Callable:
    """The distinct n-grams of each block, by order and shard."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, words, sizes in blocks(batches, 1, block_tokens):
            block = TaskContext.get().partitionId() << 32 | number
            for level, _, keys in _levels(words, positions(sizes), model["order"]):
                keys = distinct(keys)
                parts = _split(keys, model["bits"])
                yield _rows([{"block": block, "level": level, "shard": s, "keys": pack_sorted(keys[p])} for s, p in parts], ASKED)

    return ask


ANSWERED = pa.schema([*ASKED][:3] + [("n", pa.int64()), ("checksum", pa.int64()), *((f, pa.binary()) for f in KINDS)])
ANSWERED_DDL = "block long, level long, shard long, n long, checksum long, " + ", ".join(f"{f} binary" for f in KINDS)


def checksum(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(keys), initial=np.uint64(0)) >> np.uint64(1))


def _answered(model: dict) -> Callable:
    """Looks a shard's share of all blocks up in its mapped arrays."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        level, shard = (k.as_py() for k in key)
        fields = _fields(level, model["order"])
        stored = shared_arrays.load(model["folder"], f"{level}-{shard}")
        out = []
        for block, asked in zip(table.column("block").to_pylist(), table.column("keys")):
            keys = unpack_sorted(asked.as_buffer())
            row = {"block": block, "level": level, "shard": shard, "n": len(keys), "checksum": checksum(keys)}
            if stored is None or not len(stored["keys"]):
                values = {f: np.zeros(len(keys), KINDS[f]) for f in fields}
            else:
                at = np.minimum(np.searchsorted(stored["keys"], keys), len(stored["keys"]) - 1)
                known = stored["keys"][at] == keys
                values = {f: np.where(known, widened(stored, at) if f == "count" else stored[f][at], 0) for f in fields if f != "rest"}
                if "rest" in fields:
                    d = model["discounts"][level]  # of the next higher order, whose contexts these are
                    seen = [np.where(known, stored[f][at], 0).astype(np.float64) for f in ("once", "twice", "more")]
                    total = values["total"].astype(np.float64)
                    values["rest"] = sum(x * y for x, y in zip(d, seen)) / np.maximum(total, 1)
            out.append(row | {f: pack(v.astype(KINDS[f])) for f, v in values.items()})
        found = pa.Table.from_batches([_rows(out, ANSWERED)])
        del out, stored
        trim()
        return found

    return answer


def _gathered(order: int, folder: str) -> Callable:
    """All answers of a block as one file, in the order of its keys."""

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        arrays, n = {}, 0
        rows = sorted(table.select(["level", "shard", "n", "checksum", *KINDS]).to_pylist(), key=lambda r: (r["level"], r["shard"]))
        for level in range(1, order + 1):
            own = [r for r in rows if r["level"] == level]
            check = 0
            for r in own:
                check ^= r["checksum"]
            arrays[f"check-{level}"] = np.array([sum(r["n"] for r in own), check], "<i8")
            n += int(arrays[f"check-{level}"][0])
            for f in _fields(level, order):
                values = np.concatenate([unpack(r[f], KINDS[f]) for r in own]) if own else np.zeros(0, KINDS[f])
                if f == "count":
                    arrays |= {f"{name}-{level}": part for name, part in narrow(values).items()}
                    continue
                if f == "raw" and values.max(initial=0) < 1 << 32:
                    values = values.astype("<u4")
                arrays[f"{f}-{level}"] = values
        shared_arrays.save(folder, f"block-{block}", arrays)
        del rows, arrays
        trim()
        return pa.table({"block": [block], "n": [n]})

    return gather


def _scored(model: dict, folder: str, block_tokens: int, names: list[str]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, discounts = model["order"], model["discounts"]
        for number, rows, words, sizes in blocks(batches, 1, block_tokens):
            block = TaskContext.get().partitionId() << 32 | number
            answers = shared_arrays.load(folder, f"block-{block}")
            place = positions(sizes)
            p = np.full(len(words), 1 / (model["vocabulary"] + 1))
            total = np.full(len(words), model["total"])
            rest = np.full(len(words), model["rest"])
            for level, ends, keys in _levels(words, place, order):
                keys, inverse = np.unique(keys, return_inverse=True)
                at = np.zeros(len(words), np.int64)
                at[ends] = inverse
                if answers is None or answers[f"check-{level}"].tolist() != [len(keys), checksum(keys)]:
                    raise ValueError("the documents were cut into other blocks when they were read again")
                count = widened({name: answers[f"{name}-{level}"] for name in ("count", "wide_at", "wide")})
                real = (place >= max(level - 1, 1)) & (total > 0)
                own = at[real]
                p[real] = discounted(count[own], discounts[level - 1]) / total[real] + rest[real] * p[real]
                if level == 1:
                    raw = answers["raw-1"][at]
                if level < order:  # the n-gram before is the context of the next order
                    total = np.append(0.0, answers[f"total-{level}"][at[:-1]]).astype(np.float64)
                    rest = np.append(0.0, answers[f"rest-{level}"][at[:-1]]).astype(np.float64)
                    total[place < level] = 0
            scored = place > 0
            text = np.repeat(np.arange(len(sizes)), sizes)[scored]
            base = np.log10((raw[scored].astype(np.float64) + 1) / (model["train_tokens"] + model["vocabulary"] + 1))
            sums = {
                "n_tokens": sizes - 1,
                "n_known": np.bincount(text, raw[scored] > 0, len(sizes)).astype(np.int64),
                "train_tokens": np.full(len(sizes), model["train_tokens"]),
                "base_score": np.bincount(text, base, len(sizes)),
                "score": np.bincount(text, np.log10(p[scored]), len(sizes)),
            }
            table = rows.combine_chunks()
            columns = [table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0) for c in table.column_names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(v) for v in sums.values()], names=names)

    return score


def _scanned(rows: DataFrame) -> bool:
    """True if the partitions of these rows are those of a scan, which do not change when they are read again."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return "Exchange" not in plan and ("FileScan" in plan or "BatchScan" in plan)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str | Column = "text", block_tokens: int | None = None) -> DataFrame:
    """log10 probability of every text, beside that of single words with one added to each count.

    Returns the key, n_tokens, n_known, train_tokens, base_score, score and
    perplexity.  ``block_tokens`` must only fit a worker's memory.
    """
    block_tokens = block_tokens or BLOCK_TOKENS
    known = asdict(model)
    rows = docs.select(F.col(key).alias("key"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))
    if not _scanned(rows):
        rows = cut_lineage(rows, "texts")
    spark = docs.sparkSession
    folder = scratch_path(spark, "answers")
    asked = rows.mapInArrow(_asked(known, block_tokens), "block long, level long, shard long, keys binary")
    answers, path = _written(asked.groupBy("level", "shard").applyInArrow(_answered(known), ANSWERED_DDL), "replies")
    _written(answers.groupBy("block").applyInArrow(_gathered(model.order, folder), "block long, n long"), "blocks")
    remove_scratch(spark, path)
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    found = rows.mapInArrow(_scored(known, folder, block_tokens, names), schema)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))).withColumnRenamed("key", key)
