"""Benchmark decontamination by templates: the same question with other numbers, names or units is found too.

Numbers, names and units become typed placeholders; windows of the resulting
template words are hash-joined between documents and benchmark items.  Matches
that lie on one diagonal (same shift between document and item) form an
alignment.  Its slots must be consistent: everywhere it holds, one value of the
item stands for one value of the document.  If they are not, only its windows
without slots count, which match without placeholders.

Defined results: null and empty texts and items have no windows and match
nothing; items shorter than a window are one window of their own length, and those
of one to three words must be a whole text or whole lines of it; windows
with few literal words are joined on the words themselves, in lower case and
without punctuation at their edges, as placeholders alone say nothing: they match
verbatim and need no slots; repeated rows give one result per document and item;
a null item id or document id is kept; empty tables give no rows.  Only the id
and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import WORD_BASE, prefix_sums, slices, spans_hash, word_hashes
from lakeworks.llm.names import unused
from lakeworks.session import cut_lineage

#: Words of a window, literal words it needs to be a template, windows of an alignment that make a match.
WINDOW, LEAST_LITERALS, LEAST_WINDOWS = 8, 4, 3
#: Shorter items match whole lines only.
LEAST_WORDS = 4
#: Benchmark windows that executors may hold as a filter; above, every window goes into the join.
FILTER_WINDOWS = 8_000_000
#: Benchmark windows with their slots that a join may broadcast.
BROADCAST_WINDOWS = 200_000
#: Words a worker remembers.
MEMO = 500_000
# fixed values: number words and units that count as slots
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter liters "
    "litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees kmh mph meter meters metre metres gram grams kilogram kilograms"
)
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
KINDS = ("", NUMBER, NAME, UNIT)
#: Characters of texts whose words are looked up together.
TOGETHER = 1 << 18


#: Told apart from template windows in the hash of a window of real words.
VERBATIM = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Words and their numbers; a word that is new gets the next one."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = number = len(self)
        return number


def _hashes(words: Sequence[str]) -> np.ndarray:
    """64-bit hashes of words."""
    column = pa.array(words, pa.string()).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(words) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return word_hashes(data, offsets[:-1], offsets[1:])


class Words(NamedTuple):
    """Words and line marks of a text; of each word the hash of its template form and of itself, and if it is a slot."""

    marked: list[str]
    forms: np.ndarray
    reals: np.ndarray
    slots: np.ndarray
    #: Whether it is a slot when no sentence begins with it, wherever it stands.
    slots_inside: np.ndarray
    #: Whether a line begins with it.
    begins: np.ndarray


def canonical_form() -> Callable[[str], tuple[int, str, bool]]:
    """A function from a word to the kind of slot it is (0 for none), the bare word, and whether it ends a sentence."""
    numbers, units = set(NUMBER_WORDS.split()), set(UNITS.split())
    digits = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*[%°]?")
    edges = re.compile(r"^[^\w$€£+-]+|[^\w%°]+$")

    def form(word: str) -> tuple[int, str, bool]:
        ends, bare, plain = False, word, word.isalpha()
        if not plain:
            ends = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":")
            bare = word.rstrip(".,;:!?")
            plain = bare.isalpha()
            if not plain:
                bare = edges.sub("", word)
                plain = bare.isalpha()
        low = bare.lower()
        if low in numbers or (not plain and digits.fullmatch(bare)):
            return KINDS.index(NUMBER), low, ends
        if low in units:
            return KINDS.index(UNIT), low, ends
        if plain and len(bare) > 1 and bare.istitle():
            return KINDS.index(NAME), low, ends
        return 0, low, ends

    return form


class Templates:
    """Template words of texts, with a memory of the words seen."""

    LINE = "\x00"

    def __init__(self) -> None:
        self.form = canonical_form()
        self.placeholders = _hashes(KINDS)
        self._reset()

    def _reset(self) -> None:
        self.index = _Numbers()
        kind = [("mid", "u8"), ("start", "u8"), ("real", "u8"), ("slot_mid", "?"), ("slot_start", "?"), ("ends", "?")]
        self.table = np.zeros(1 << 16, dtype=kind)

    def _settle(self) -> None:
        """Fill the table's rows of the words that are new, all at once."""
        n, new = len(self.index), self.index.fresh
        if not new:
            return
        while len(self.table) < n:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        kinds, lows, ends = zip(*[(0, "", True) if word == self.LINE else self.form(word) for word in new])
        kind, hashes, own = np.array(kinds), _hashes(lows), self.table[n - len(new) : n]
        # a name at the start of a sentence may be any word
        anywhere = (kind > 0) & (kind != KINDS.index(NAME))
        own["mid"] = np.where(kind > 0, self.placeholders[kind], hashes)
        own["start"] = np.where(anywhere, self.placeholders[kind], hashes)
        own["real"], own["slot_mid"], own["slot_start"], own["ends"] = hashes, kind > 0, anywhere, ends
        self.index.fresh = []

    def each(self, texts: list[str]) -> Iterator[Words]:
        """The words of each text in turn; new words of texts that are together are looked into together."""
        first = 0
        while first < len(texts):
            if len(self.index) > MEMO:
                self._reset()
            last, chars = first, 0
            listed = []
            while last < len(texts) and chars < TOGETHER:
                marked = texts[last].replace(self.LINE, " ").replace("\n", f" {self.LINE} ").split()
                listed.append((marked, np.fromiter(map(self.index.__getitem__, marked), np.int64, len(marked))))
                chars += len(texts[last])
                last += 1
            self._settle()
            yield from (self._words(marked, numbers) for marked, numbers in listed)
            first = last

    def _words(self, marked: list[str], numbers: np.ndarray) -> Words:
        if not marked:
            none = np.zeros(0, np.uint64)
            return Words([], none, none, none.astype(bool), none.astype(bool), none.astype(bool))
        own = self.table[numbers]
        first = np.ones(len(numbers), dtype=bool)
        first[1:] = own["ends"][:-1]
        real = numbers != self.index.get(self.LINE, -1)
        forms = np.where(first, own["start"], own["mid"])[real]
        slots = np.where(first, own["slot_start"], own["slot_mid"])[real]
        begins = np.concatenate(([True], ~real[:-1]))[real]
        return Words(marked, forms, own["real"][real], slots, own["slot_mid"][real], begins)

    def words(self, marked: list[str]) -> list[str]:
        """The words alone."""
        return [w for w in marked if w != self.LINE]


def _windows(words: Words, size: int, verbatim: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows of ``size`` words: of those with enough literal words, or of the others.

    Whether a window has too few does not depend on what stands before it, so a
    copy has the same ones; a window may be both.
    """
    n = len(words.forms) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    filled = np.concatenate(([0], np.cumsum(words.slots)))
    least = min(LEAST_LITERALS, (size + 1) // 2)
    if not verbatim:
        at = at[size - (filled[at + size] - filled[at]) >= least]
        return at, spans_hash(prefix_sums(words.forms, WORD_BASE), at, at + size, WORD_BASE) ^ np.uint64(size)
    literal = size - words.slots_inside[:n] - (filled[at + size] - filled[at + 1])
    at = at[literal < least]
    if not len(at):
        return at, np.zeros(0, np.uint64)
    return at, spans_hash(prefix_sums(words.reals, WORD_BASE), at, at + size, WORD_BASE) ^ np.uint64(size) ^ VERBATIM


def template_windows(
    rows: DataFrame,
    kinds: list[tuple[int, bool]],
    whole: bool = False,
    wanted: np.ndarray | None = None,
    lines_below: int = 0,
) -> DataFrame:
    """Windows of the texts of (key, tag, text): h, key, tag, size, verbatim, pos and the values in the slots.

    ``kinds``: sizes, and whether of template words or verbatim; verbatim
    windows have no slots.  ``whole``: texts shorter than the window are one window of their own
    length.  ``wanted``: sorted hashes; other windows are left out.
    ``lines_below``: smaller windows must begin and end where lines do.
    """
    held = rows.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None
    names = ["h", "key", "tag", "size", "verbatim", "pos", "slots"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in slices(batches):
            out: list[list] = [[] for _ in names]
            batch = batch.filter(pc.greater(pc.fill_null(pc.binary_length(batch.column(2)), 0), 0))
            keys, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, tag, words in zip(keys, tags, templates.each(batch.column(2).to_pylist())):
                slots = words.slots
                listed: list[str] | None = None
                for size, verbatim in kinds:
                    size = min(size, len(slots)) if whole else size
                    if size == 0:
                        continue
                    at, found = _windows(words, size, verbatim)
                    if held is not None and len(found):
                        place = np.searchsorted(held.value, found)
                        place[place == len(held.value)] = 0
                        match = held.value[place] == found
                        at, found = at[match], found[match]
                    if size < lines_below:
                        lines = words.begins[at] & np.append(words.begins, True)[at + size]
                        at, found = at[lines], found[lines]
                    if not len(at):
                        continue
                    out[0].extend(found.view(np.int64).tolist())
                    out[1].extend([key] * len(at))
                    out[2].extend([tag] * len(at))
                    out[3].extend([size] * len(at))
                    out[4].extend([verbatim] * len(at))
                    out[5].extend(at.tolist())
                    if verbatim:
                        out[6].extend([[]] * len(at))
                        continue
                    filled = np.concatenate(([0], np.cumsum(slots)))
                    listed = listed or templates.words(words.marked)
                    for p in at.tolist():
                        any_slot = filled[p + size] > filled[p]
                        values = [listed[q].lower().strip(".,;:!?\"'()") for q in range(p, p + size) if slots[q]]
                        out[6].append(values if any_slot else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.int32()),
                    pa.array(out[4], pa.bool_()),
                    pa.array(out[5], pa.int64()),
                    pa.array(out[6], pa.list_(pa.string())),
                ],
                names=names,
            )

    return rows.mapInArrow(cut, "h long, key long, tag long, size int, verbatim boolean, pos long, slots array<string>")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    least_windows: int = LEAST_WINDOWS,
) -> DataFrame:
    """One row per document and item: doc_id, text_hash, item_id, n_windows, coverage, n_slots.

    ``n_windows`` counts the item's windows in its best alignment, those without
    slots if its slots are inconsistent (``n_slots`` is 0 then),
    ``coverage`` is the share of the item's windows that they cover: a window with
    few literal words that is not verbatim is covered if each of its words lies in
    one of them.
    """
    content = F.col(text).cast("string").alias("text")
    asked = benchmark.select(F.col(item).cast("long").alias("key"), F.lit(0).cast("long").alias("tag"), content)
    items = cut_lineage(
        template_windows(asked, [(window, False), (window, True)], whole=True)
        .select(
            "h",
            F.col("key").alias("item_id"),
            "size",
            "verbatim",
            F.col("pos").alias("item_pos"),
            F.col("slots").alias("item_slots"),
        )
        .dropDuplicates(["h", "item_id", "item_pos"]),
        "items",
    )
    template_pos = F.when(~F.col("verbatim"), F.col("item_pos"))
    totals = items.groupBy(F.col("item_id").alias("of_item")).agg(
        F.countDistinct("item_pos").alias("item_windows"), F.countDistinct(template_pos).alias("item_templates")
    )
    shape = items.agg(F.count("*").alias("n"), F.collect_set(F.struct("size", "verbatim")).alias("kinds")).first()
    kinds = sorted(map(tuple, shape["kinds"]), reverse=True)  # at most ``window`` different sizes
    wanted = None
    if shape["n"] <= FILTER_WINDOWS:
        hashes = items.select("h").distinct().toPandas()["h"].to_numpy(dtype=np.int64)
        wanted = np.sort(hashes.view(np.uint64))
    if not shape["n"]:
        docs = docs.filter(F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.col(text).cast("string")).alias("tag"), content)
    found = template_windows(rows, kinds, wanted=wanted, lines_below=min(LEAST_WORDS, window)).drop("size", "verbatim")
    sought = items
    pairs = found.join(F.broadcast(sought) if shape["n"] <= BROADCAST_WINDOWS else sought, "h")
    pairs = pairs.withColumn("shift", F.col("pos") - F.col("item_pos"))
    slots = F.arrays_zip(F.col("item_slots").alias("of_item"), F.col("slots").alias("of_doc"))
    # an alignment has at most one row per window of its item
    aligned = pairs.groupBy("key", "tag", "item_id", "shift").agg(
        F.collect_set(F.struct("item_pos", "verbatim", (F.size("item_slots") == 0).alias("plain"))).alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"),
        F.max("size").alias("size"),
    )
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["of_item"])))
    aligned = (
        aligned.withColumn("consistent", consistent)
        .withColumn("windows", F.filter("windows", lambda w: F.col("consistent") | w["plain"]))
        .withColumn("places", F.array_sort(F.array_distinct(F.col("windows.item_pos"))))
        .filter(F.size("places") > 0)
    )
    n_templates = F.size(F.array_distinct(F.filter("windows", lambda w: ~w["verbatim"])["item_pos"]))
    aligned = aligned.select(
        "key",
        "tag",
        "item_id",
        "size",
        "places",
        F.size("places").alias("n_windows"),
        n_templates.alias("n_templates"),
        F.when(F.col("consistent"), F.size("slots")).otherwise(0).alias("n_slots"),
    )
    # between two windows that meet or overlap, all are covered
    steps = F.zip_with(
        F.slice("places", 2, F.size("places")),
        F.slice("places", 1, F.size("places") - 1),
        lambda after, before: F.when(after - before <= F.col("size"), after - before).otherwise(1),
    )
    n_covered = F.aggregate(steps, F.lit(1).cast("long"), lambda total, step: total + step)
    # the template windows alone may be enough, however many others the item has
    enough = (F.col("n_windows") >= F.least(F.lit(least_windows), F.col("item_windows"))) | (
        (F.col("item_templates") > 0) & (F.col("n_templates") >= F.least(F.lit(least_windows), F.col("item_templates")))
    )
    best = (
        aligned.join(totals, F.col("item_id").eqNullSafe(F.col("of_item")))
        .filter(enough)
        .groupBy("key", "tag", "item_id", "item_windows")
        .agg(F.max(F.struct(F.col("n_windows").cast("long").alias("n_windows"), "n_slots", n_covered.alias("n_covered"))).alias("best"))
    )
    return best.select(
        F.col("key").alias("doc_id"),
        F.col("tag").alias("text_hash"),
        "item_id",
        "best.n_windows",
        (F.col("best.n_covered") / F.col("item_windows")).alias("coverage"),
        "best.n_slots",
    )


def without_matches(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that :func:`matches` found, all columns unchanged."""
    hit, tag = unused(docs.columns, "_hit", "_tag")
    hits = found.select(F.col("doc_id").alias(hit), F.col("text_hash").alias(tag)).distinct()
    same = F.col(key).cast("long").eqNullSafe(F.col(hit)) & (F.xxhash64(F.col(text).cast("string")) == F.col(tag))
    return docs.join(hits, same, "left_anti")
