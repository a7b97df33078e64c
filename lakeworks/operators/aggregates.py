"""Grouped counts, ordered text aggregation, bounds and tallies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.joins import sized_lookup
from lakeworks.operators.ordering import GROUP_ROWS, large_groups, with_slices


def ordered_text(
    df: DataFrame,
    group: list[str],
    value: Column,
    sep: str,
    as_name: str,
    order: Column | None = None,
    stretch: Column | None = None,
) -> DataFrame:
    """One text per group: values joined by ``sep`` in ``order`` (default: by value).

    NULL values are left out; a group of only NULLs gives the empty text.
    ``stretch`` is a number that never decreases with ``order``; with it each
    (group, stretch) is sorted and joined on its own first, so that a group
    holding much of the data is sorted by many tasks and only its finished
    pieces, the result cell itself, meet in one.
    """
    text = value.cast("string")
    item = F.struct((order if order is not None else value).alias("k"), text.alias("v"))
    kept = F.when(value.isNotNull(), item)

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(items), lambda i: i["v"]), sep)

    if stretch is None:
        return df.groupBy(*group).agg(joined(F.collect_list(kept)).alias(as_name))
    pieces = df.groupBy(*group, stretch.alias("_stretch")).agg(F.collect_list(kept).alias("_items"))
    pieces = pieces.select(
        *group,
        F.when(F.size("_items") > 0, F.struct("_stretch", joined(F.col("_items")).alias("v"))).alias(
            "_piece"
        ),
    )
    whole = F.sort_array(F.collect_list("_piece"))
    return pieces.groupBy(*group).agg(
        F.array_join(F.transform(whole, lambda p: p["v"]), sep).alias(as_name)
    )


def _same(group: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{prefix}{g}"))
    return same


def text_chunks(
    df: DataFrame,
    group: list[str],
    value: Column,
    sep: str,
    order: Column,
    position: Column,
    chunk_chars: int = 1 << 20,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The text :func:`ordered_text` gives, in rows of bounded size: group, chunk, start, text.

    ``start`` is the place of a chunk's first character in the group's text, and the
    chunks of a group in order of ``chunk`` make that text.  A chunk starts no
    more than ``chunk_chars`` characters after the one before it and holds whole
    values with the separators before them; a long value may skip chunk numbers.
    No task holds a group: large groups are cut by ``position``, a numeric form of
    ``order``, lengths are added up by slice, and only then is text put together.
    Equal order values follow by value, or by hash where they pile up.  A group of
    only NULLs has no chunks; :func:`text_sizes` lists it.
    """
    rows = df.filter(value.isNotNull()).select(*group, order.alias("_k"), position.alias("_p"), value.cast("string").alias("_v"))
    large = large_groups(rows, group, F.col("_p"), group_rows, "_k")
    sliced = rows.withColumn("_slice", F.lit(0).cast("bigint")) if large is None else with_slices(rows, group, F.col("_p"), large, "left")
    sizes = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_n"), F.sum(F.length("_v")).alias("_chars"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.col("_slice").alias("_o_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_chars_before"),
    )
    placed = sliced.join(sized_lookup(offsets), _same(group, "_o_") & (F.col("_slice") == F.col("_o_slice")))
    inside = Window.partitionBy(*group, "_slice").orderBy("_k", "_v")
    number = F.col("_n_before") + F.row_number().over(inside) - 1
    chars = F.col("_chars_before") + F.sum(F.length("_v")).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.length("_v")
    pieces = placed.select(
        *group,
        number.alias("_number"),
        (chars + F.greatest(number - 1, F.lit(0)) * len(sep)).alias("_start"),
        F.when(number == 0, F.col("_v")).otherwise(F.concat(F.lit(sep), "_v")).alias("_piece"),
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_number", "_piece"))), lambda p: p["_piece"]), "")
    chunk = F.floor(F.col("_start") / chunk_chars).alias("chunk")
    return pieces.groupBy(*group, chunk).agg(F.min("_start").alias("start"), joined.alias("text"))


def text_sizes(df: DataFrame, group: list[str], value: Column, sep: str) -> DataFrame:
    """Values and characters of each group's joined text, without making it."""
    text = value.cast("string")
    n = F.count(text)
    chars = F.coalesce(F.sum(F.length(text)), F.lit(0)) + F.greatest(n - 1, F.lit(0)) * len(sep)
    return df.groupBy(*group).agg(n.alias("n_values"), chars.alias("n_chars"))


def group_counts(df: DataFrame, by: list[str], as_name: str) -> DataFrame:
    """Rows per group, smallest group first."""
    return df.groupBy(*by).agg(F.count("*").alias(as_name)).orderBy(as_name, *by)


def filled_per_group(df: DataFrame, by: list[str], column: str, as_name: str) -> DataFrame:
    """Non-NULL values of a column per group."""
    return df.groupBy(*by).agg(F.count(column).alias(as_name))


def row_tallies(stages: dict[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """Found against expected rows of every stage.

    Each stage is ``(rows, expected)``; ``expected`` is an aggregate expression
    over the stage's own rows, or None when nothing is expected.
    """
    counted = [
        df.agg(
            F.count("*").alias("found"),
            (F.lit(None) if expected is None else expected).cast("bigint").alias("expected"),
        ).select(F.lit(name).alias("stage"), "found", "expected")
        for name, (df, expected) in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def any_match(df: DataFrame, condition: Column, as_name: str) -> DataFrame:
    """1 if any row meets the condition, else 0 (NULL without rows)."""
    return df.agg(F.max(F.when(condition, 1).otherwise(0)).alias(as_name))


def duplicate_keys(df: DataFrame, keys: list[str], as_name: str = "n_rows") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(as_name)).filter(F.col(as_name) > 1)
