"""Chat formatting with minimum-cost role repair.

A conversation must walk a legal-turn automaton: an optional system turn, then
user and assistant in turn, the assistant last.  Dynamic programming over the
automaton's states finds the cheapest mix of merges, relabels and empty
insertions that makes it do so; the repaired sequence is rendered with role
markers.

A conversation may be of any length: beyond ``LONG`` turns its turns are ranked
by a range sort and cut by rank, each stretch yields the cost of going from any
state to any other, the stretches' costs are chained, and each stretch is then
repaired between the states found for it.  The result is that of one pass.
Output rows are pieces, one for each input turn or inserted turn, so nothing
ever gathers a whole long conversation.

Defined results: null texts are empty, null and unknown roles must be relabelled,
roles are compared in lower case without outer blanks; turns are ordered by
number (null first), then role, then the hash of the text, and repeated rows are
turns of their own; turns of one number are cut apart where they are many; a null
conversation id is a conversation; an empty table gives no rows.  Equal costs are settled by a second
cost, a checksum of turn number and state, that adds up along the walk as the
first does.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.session import cut_lineage

#: Turns of a stretch.
LONG = 10_000
#: Costs are counted in these units; the second cost fills what is below.
UNIT = 1 << 62
INFINITE = UNIT << 50
# fixed values: states and legal steps; the state is the role of the last turn written
STATES = ("start", "system", "user", "assistant")
LEGAL = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
#: Empty turns that make a step legal.
BRIDGES = {
    ("start", "assistant"): ("user",),
    ("system", "assistant"): ("user",),
    ("user", "user"): ("assistant",),
    ("assistant", "assistant"): ("user",),
}
#: Empty turns that end a conversation legally.
ENDINGS = {"start": ("user", "assistant"), "system": ("user", "assistant"), "user": ("assistant",), "assistant": ()}


@dataclass(frozen=True)
class Format:
    """Costs of the repairs and the marks of the rendered text."""

    merge: int = 1
    relabel: int = 3
    insert: int = 2
    open: str = "<|{role}|>\n"
    close: str = "<|end|>\n"
    joint: str = "\n\n"
    roles: tuple[str, ...] = field(default=STATES[1:])


def steps(form: Format, role: str | None) -> dict[tuple[int, int], tuple[int, str, tuple[str, ...]]]:
    """For a turn of ``role``: (state, next state) to cost, action and the empty turns before it."""
    known = (role or "").strip().lower()
    found = {}
    for p, state in enumerate(STATES):
        for label in form.roles:
            q = STATES.index(label)
            base, kept = (0, "keep") if label == known else (form.relabel, "relabel")
            options = []
            if label in LEGAL[state]:
                options.append((base, kept, ()))
            elif (state, label) in BRIDGES:
                between = BRIDGES[state, label]
                options.append((base + form.insert * len(between), kept, between))
            if label == state:
                options.append((base + form.merge, "merge" if kept == "keep" else "relabel+merge", ()))
            if options:
                found[p, q] = min(options, key=lambda o: o[0])
    return found


class Repair:
    """Costs and cheapest walks; the steps of each role are worked out once."""

    def __init__(self, form: Format) -> None:
        self.form = form
        self.known: dict[str | None, dict] = {}

    def steps(self, role: str | None) -> dict:
        if role not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            self.known[role] = steps(self.form, role)
        return self.known[role]

    def advance(self, costs: list[int], role: str | None, second: list[int]) -> tuple[list[int], list[int]]:
        """Costs after one more turn, and the state each came from."""
        after, source = [INFINITE] * 4, [0] * 4
        for (p, q), (cost, _, _) in self.steps(role).items():
            # the state left counts too, so that no two walks weigh the same
            total = costs[p] + cost * UNIT + second[4 * p + q]
            if total < after[q]:
                after[q], source[q] = total, p
        return after, source

    @staticmethod
    def seconds(turns: list[tuple], skip: int = 0) -> Iterator[list[int]]:
        """The second costs of each turn, by the states around it; ``skip`` turns of the first number came before."""
        for number, same in groupby(turns, key=lambda t: t[0]):
            for k, _ in enumerate(same, skip):
                yield [zlib.crc32(f"{number}:{k}:{step}".encode()) & 0xFFFFF for step in range(16)]
            skip = 0

    def matrix(self, turns: list[tuple], skip: int = 0) -> list[int]:
        """Cheapest cost from each state to each over the turns, row by row; both costs of each."""
        rows = [[INFINITE] * 4 for _ in range(4)]
        for start in range(4):
            rows[start][start] = 0
        for (_, role, _), second in zip(turns, self.seconds(turns, skip)):
            rows = [self.advance(costs, role, second)[0] for costs in rows]
        return [part for costs in rows for cost in costs for part in divmod(cost, UNIT)]

    def ending(self, costs: list[int]) -> int:
        """The state to end in."""
        return min(range(4), key=lambda q: (costs[q] + self.form.insert * UNIT * len(ENDINGS[STATES[q]]), q))

    def walk(self, turns: list[tuple], start: int, end: int | None, skip: int = 0) -> list[int]:
        """States before, between and after the turns."""
        costs = [INFINITE] * 4
        costs[start] = 0
        sources = []
        for (_, role, _), second in zip(turns, self.seconds(turns, skip)):
            costs, source = self.advance(costs, role, second)
            sources.append(source)
        states = [self.ending(costs) if end is None else end]
        for source in reversed(sources):
            states.append(source[states[-1]])
        return states[::-1]

    def pieces(
        self, turns: list[tuple], start: int, end: int | None, first: bool, last: bool, skip: int = 0
    ) -> list[tuple]:
        """Pieces of a stretch: opens a turn, role, action, source turn, cost, rendered text."""
        form = self.form
        states = self.walk(turns, start, end, skip)
        out: list[list] = []

        def write(role: str, action: str, number, cost: int, text: str, joined: bool) -> None:
            if joined:
                out.append([False, role, action, number, cost, form.joint + text])
                return
            closing = "" if first and not out else form.close
            out.append([True, role, action, number, cost, closing + form.open.format(role=role) + text])

        for (number, role, text), p, q in zip(turns, states, states[1:]):
            cost, action, between = self.steps(role)[p, q]
            for extra in between:
                write(extra, "insert", None, form.insert, "", False)
            write(STATES[q], action, number, cost - form.insert * len(between), text or "", action.endswith("merge"))
        if last:
            for extra in ENDINGS[STATES[states[-1]]]:
                write(extra, "insert", None, form.insert, "", False)
            out[-1][-1] += form.close
        return [tuple(p) for p in out]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal leading columns, across batches."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for key, own in groupby(rows, key=lambda row: row[:keys]):
        yield key, [row[keys:] for row in own]


def _tables(rows: Iterator[tuple], schema: pa.Schema, most: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield batch()
            held = []
    yield batch()


_ORDER = ["conv", "stretch", "turn", "role", "code", "text"]


def _ranked(turns: DataFrame) -> DataFrame:
    """Adds ``rank``, the place of each turn in its conversation from 0.

    A range sort deals the turns, so that one conversation, one number or one row
    repeated is split among tasks; counts of the ranges move the places in them.
    """
    # written first: the numbers that tell equal rows apart must not change when a task is run again
    numbered = cut_lineage(turns.withColumn("row", F.monotonically_increasing_id()), "long_turns")
    order = ["conv", "turn", "role", "code", "row"]
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(
        ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "placed"
    )
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("at").alias("lo"))
    moves = counts.select(
        F.col("conv").alias("_conv"),
        F.col("part").alias("_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo")).alias("_move"),
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    return placed.join(cut_lineage(moves, "moves"), same).select(*turns.columns, (F.col("at") + F.col("_move")).alias("rank"))


def _stretched(turns: DataFrame, long: int) -> tuple[DataFrame, bool]:
    """Adds the stretch of each turn, the conversation's number of stretches, and skip.

    ``skip`` counts the turns of the stretch's first number that lie in earlier stretches.
    """
    sizes = turns.groupBy(F.col("conv").alias("_conv")).agg(F.count("*").alias("_n")).filter(F.col("_n") > long)
    sizes = cut_lineage(sizes, "sizes")
    alone = {"stretch": F.lit(0), "n_stretches": F.lit(1), "skip": F.lit(0).cast("long")}
    if sizes.isEmpty():
        return turns.withColumns(alone), False
    known = F.col("conv").eqNullSafe(F.col("_conv"))
    ranked = cut_lineage(_ranked(turns.join(sizes, known).drop("_conv")), "ranked")
    stretch = F.floor(F.col("rank") / long).cast("int")
    numbers = ranked.groupBy("conv", "turn").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    cut_numbers = numbers.select(
        F.col("conv").alias("_conv"),
        "lo",
        F.floor(F.col("lo") / long).cast("int").alias("a"),
        F.floor(F.col("hi") / long).cast("int").alias("b"),
    ).filter("a < b")
    skips = cut_numbers.select("_conv", "lo", F.explode(F.sequence(F.col("a") + 1, F.col("b"))).alias("_stretch")).select(
        "_conv", "_stretch", (F.col("_stretch").cast("long") * long - F.col("lo")).alias("_skip")
    )
    big = ranked.withColumn("stretch", stretch).withColumn("n_stretches", F.ceil(F.col("_n") / long).cast("int"))
    same = known & (F.col("stretch") == F.col("_stretch"))
    big = big.join(cut_lineage(skips, "skips"), same, "left").withColumn("skip", F.coalesce("_skip", F.lit(0).cast("long")))
    small = turns.join(sizes, known, "left_anti").withColumns(alone)
    return small.unionByName(big.select(*small.columns)), True


def _states_between(turns: DataFrame, form: Format) -> DataFrame:
    """For each stretch of a cut conversation the states it starts and ends in: conv, stretch, begin, finish, last."""
    matrix_schema = pa.schema([("conv", pa.int64()), ("stretch", pa.int32()), ("costs", pa.list_(pa.int64()))])
    state_schema = pa.schema(
        [("conv", pa.int64()), ("stretch", pa.int32()), ("begin", pa.int32()), ("finish", pa.int32()), ("last", pa.bool_())]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair(form)
        rows = ((*key, repair.matrix([row[:3] for row in own], own[0][3])) for key, own in _groups(batches, 2))
        yield from _tables(rows, matrix_schema)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair(form)

        def rows() -> Iterator[tuple]:
            for (conv,), own in _groups(batches, 1):
                costs, sources = [0, INFINITE, INFINITE, INFINITE], []
                for _, parts in own:
                    matrix = [a * UNIT + b for a, b in zip(parts[::2], parts[1::2])]
                    options = [[(costs[p] + matrix[4 * p + q], p) for p in range(4)] for q in range(4)]
                    costs, source = zip(*(min(o) for o in options))
                    sources.append(source)
                state = repair.ending(list(costs))
                found = []
                for (stretch, _), source in zip(own[::-1], sources[::-1]):
                    found.append((conv, stretch, source[state], state, not found))
                    state = source[state]
                yield from found

        yield from _tables(rows(), state_schema)

    cut = turns.filter("n_stretches > 1").select(*_ORDER, "skip")
    matrices = (
        cut.repartition("conv", "stretch")
        .sortWithinPartitions(*_ORDER)
        .drop("code")
        .mapInArrow(measure, "conv long, stretch int, costs array<long>")
    )
    return (
        matrices.repartition("conv")
        .sortWithinPartitions("conv", "stretch")
        .mapInArrow(chain, "conv long, stretch int, begin int, finish int, last boolean")
    )


def repaired(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    form: Format | None = None,
    long: int = LONG,
) -> DataFrame:
    """Pieces of the repaired conversations.

    Returns conv_id, piece (from 0), out_turn (from 0), role, action (keep,
    merge, relabel, relabel+merge, insert), source_turn (null for an insertion),
    cost, rendered.  The rendered pieces of a conversation, put together in
    order, are its text.
    """
    form = form or Format()
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("code"),
    )
    rows, any_cut = _stretched(rows, long)
    whole = F.struct(
        F.lit(0).alias("begin"), F.lit(None).cast("int").alias("finish"), F.lit(True).alias("last")
    )
    if any_cut:
        between = cut_lineage(_states_between(rows, form), "states").select(
            F.col("conv").alias("_conv"),
            F.col("stretch").alias("_stretch"),
            F.struct("begin", "finish", "last").alias("_states"),
        )
        same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
        rows = rows.join(between, same, "left").withColumn("states", F.coalesce("_states", whole))
    else:
        rows = rows.withColumn("states", whole)
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("stretch", pa.int32()),
            ("piece", pa.int64()),
            ("out_turn", pa.int64()),
            ("role", pa.string()),
            ("action", pa.string()),
            ("source_turn", pa.int64()),
            ("cost", pa.int64()),
            ("rendered", pa.string()),
        ]
    )

    def repair_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair(form)

        def out() -> Iterator[tuple]:
            for (number, stretch), own in _groups(batches, 2):
                skip, begin, finish, last = own[0][3:]
                opened = -1
                pieces = repair.pieces([row[:3] for row in own], begin, finish, stretch == 0, last, skip)
                for k, (opens, *rest) in enumerate(pieces):
                    opened += opens
                    yield (number, stretch, k, opened, *rest)

        yield from _tables(out(), schema)

    flat = [*_ORDER, "skip", "states.begin", "states.finish", "states.last"]
    found = (
        rows.select(*flat)
        .repartition("conv", "stretch")
        .sortWithinPartitions(*_ORDER)
        .drop("code")
        .mapInArrow(
            repair_all,
            "conv_id long, stretch int, piece long, out_turn long, role string, action string, "
            "source_turn long, cost long, rendered string",
        )
    )
    if any_cut:
        found = _numbered(cut_lineage(found, "pieces"))
    return found.drop("stretch")


def _numbered(found: DataFrame) -> DataFrame:
    """Numbers of pieces and turns across the stretches of a conversation."""
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        found.groupBy("conv_id", "stretch")
        .agg(F.count("*").alias("n"), (F.max("out_turn") + 1).alias("m"))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("stretch").alias("_stretch"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
            F.coalesce(F.sum("m").over(before), F.lit(0)).alias("_m"),
        )
        .filter("_stretch > 0")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
    return (
        found.join(cut_lineage(counts, "piece_counts"), same, "left")
        .withColumn("piece", F.col("piece") + F.coalesce("_n", F.lit(0)))
        .withColumn("out_turn", F.col("out_turn") + F.coalesce("_m", F.lit(0)))
        .drop("_conv", "_stretch", "_n", "_m")
    )


def rendered(pieces: DataFrame) -> DataFrame:
    """Conversations as one text each: conv_id, text, cost.  Only for conversations that fit a cell."""
    ordered = F.array_sort(F.collect_list(F.struct("piece", "rendered")))
    return pieces.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["rendered"]), "").alias("text"), F.sum("cost").alias("cost")
    )
