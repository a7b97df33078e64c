"""Neighbours in an ordered group, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.session import cut_lineage

#: A group up to this size is ordered by one task; larger ones are cut into slices.
GROUP_ROWS = 4_000_000


#: Slices of one position are numbered below this; slices of other positions lie this far apart.
POSITION_SLICES = 1 << 31
#: A row is compared with fewer bounds than this at a time, however many its group has.
STEP = 32


def large_groups(
    df: DataFrame, group: list[str], position: Column, group_rows: int = GROUP_ROWS, order: str | None = None
) -> DataFrame | None:
    """Groups of more than ``group_rows`` rows, with cuts of their positions; None if there are none.

    With ``order`` the table also lists the positions where more than
    ``group_rows`` rows of one value pile up, and how many slices they need.

    The cuts are approximate quantiles, so slices hold about equally many rows
    however the positions lie.  The table has at most rows/``group_rows``
    entries, and about as many cuts in all, which is what makes its broadcast safe.
    It is written once, as the cuts must be the same wherever rows are placed by them.
    """
    value = F.lit(None) if order is None else F.col(order)
    named = df.select(*[F.col(g).alias(f"_g_{g}") for g in group], position.cast("double").alias("_pos"), value.alias("_value"))
    keys = [f"_g_{g}" for g in group]
    counted = named.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > group_rows)
    most = counted.agg(F.max("_rows")).first()[0]
    if most is None:
        return None
    parts = -(-most // group_rows)
    wanted = counted.select(*[F.col(k).alias(f"_w{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_w{k}"))
    at = F.expr(f"array({', '.join(f'{k / parts!r}D' for k in range(1, parts))})")  # one call for all of them
    cuts = F.array_distinct(F.percentile_approx("_pos", at, F.lit(min(20 * parts, 1_000_000))))
    rows = named.join(F.broadcast(wanted), same, "left_semi")
    found = rows.groupBy(*keys).agg(cuts.alias("_cuts"))
    if order is None:
        return cut_lineage(found, "cuts")
    piles = (
        rows.groupBy(*keys, "_pos")
        .agg(F.count("*").alias("_n"), F.min("_value").eqNullSafe(F.max("_value")).alias("_one_value"))
        .filter((F.col("_n") > group_rows) & F.col("_one_value"))
    )
    pile = F.struct(F.col("_pos").alias("pos"), F.ceil(F.col("_n") / group_rows).alias("parts"))
    listed = piles.groupBy(*[F.col(k).alias(f"_p{k}") for k in keys]).agg(F.collect_list(pile).alias("_piles"))
    at = F.lit(True)
    for k in keys:
        at = at & F.col(k).eqNullSafe(F.col(f"_p{k}"))
    return cut_lineage(found.join(listed, at, "left").select(*keys, "_cuts", "_piles"), "cuts")


def with_slices(
    df: DataFrame, group: list[str], position: Column, large: DataFrame, how: str
) -> DataFrame:
    """Add ``_slice``, which never decreases with ``position`` inside a group.

    Rows without a position come first.  A position where rows pile up is a slice
    of its own, dealt by the rows' hash into as many as it needs.  Rows of groups
    not in ``large`` get slice 0 (``how="left"``) or drop out (``how="inner"``).
    """
    at, keys = F.col("_at"), [f"_g_{g}" for g in group]
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    bounds, piles = F.col("_cuts"), None
    if "_piles" in large.columns:
        listed = F.coalesce("_piles", F.array().cast(large.schema["_piles"].dataType))
        piles = large.select(*keys, F.explode(listed).alias("_pile")).select(*keys, "_pile.pos", "_pile.parts")
        # a piled position lies alone: one step up before it and one behind it
        piled = F.filter(F.transform(listed, lambda p: p["pos"]), lambda p: p.isNotNull())
        bounds = F.array_sort(F.concat(F.coalesce("_cuts", F.array().cast("array<double>")), piled, piled))
    cut = F.col("_cuts").isNotNull().alias("_cut")
    tree = large.select(*keys, cut, bounds.alias("_bounds"))
    most = tree.agg(F.max(F.size("_bounds"))).first()[0] or 0
    width = 1
    while width * STEP <= most:
        width *= STEP

    def placed(rows: DataFrame, nodes: DataFrame, on: Column, how: str) -> DataFrame:
        """``_number`` of a wide stretch of bounds becomes that of a stretch inside it."""
        below = F.when(F.col("_few").isNull(), 0).otherwise(F.size(F.filter("_few", lambda bound: bound < at)))
        kept = [c for c in rows.columns if c != "_number"]
        if "_cut" not in kept:
            kept.append("_cut")
        return rows.join(F.broadcast(nodes), on, how).select(*kept, (F.col("_number") * STEP + below).alias("_number"))

    # as in a search tree, a row meets the last bounds of wide stretches first, then those inside its own
    every = width
    first = F.filter("_bounds", lambda _, k: (k + 1) % every == 0)
    rows = df.withColumns({"_at": position.cast("double"), "_number": F.lit(0).cast("bigint")})
    rows = placed(rows, tree.select(*keys, "_cut", first.alias("_few")), same, how)
    while width > 1:
        width //= STEP
        ranked = tree.select(*keys, F.posexplode("_bounds").alias("_k", "_bound")).withColumn("_k", F.col("_k") + 1)
        inner = ranked.filter((F.col("_k") % width == 0) & (F.col("_k") % (width * STEP) != 0))
        node = F.floor(F.col("_k") / (width * STEP)).alias("_node")
        nodes = inner.groupBy(*keys, node).agg(F.collect_list("_bound").alias("_few"))
        rows = placed(rows, nodes, same & (F.col("_number") == F.col("_node")), "left")
    number, own = F.col("_number"), F.lit(1)
    if piles is not None:
        rows = rows.join(F.broadcast(piles), same & at.eqNullSafe(F.col("pos")), "left")
        number = number + F.when(F.col("pos").isNull(), 0).otherwise(1)
        own = F.coalesce("parts", F.lit(1))
    dealt = F.pmod(F.xxhash64(*df.columns), own)
    slot = F.when(at.isNull(), 0).otherwise(number + 1).cast("bigint") * POSITION_SLICES + dealt
    sliced = F.when(F.coalesce("_cut", F.lit(False)), slot).otherwise(0)
    return rows.select(*[F.col(c) for c in df.columns], sliced.cast("bigint").alias("_slice"))


def with_next(
    df: DataFrame,
    group: list[str],
    order: str,
    values: dict[str, str],
    position: Column,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add columns of the next row of the group in ``order``.

    ``values`` maps new column names to existing ones; ``position`` is a numeric
    form of ``order`` for cutting large groups, NULL where ``order`` is; such rows
    come first.  A small job counts the groups first.  All rows are shuffled once,
    by group and slice.  Each slice of a large group also receives a copy of the
    first row of the following slice, so the last row of a slice finds its
    neighbour without the group ever meeting in one task.  That holds for rows
    piled up at one value of ``order`` too, in whose order their hash decides;
    rows that are equal in all columns stay together.
    """
    columns = df.columns
    large = large_groups(df, group, position, group_rows, order)
    if large is None:
        ahead = Window.partitionBy(*group).orderBy(order)
        return df.select("*", *[F.lead(v).over(ahead).alias(name) for name, v in values.items()])
    ordered = [order, *(c for c in columns if c != order)]
    row = F.struct(*[F.col(c) for c in ordered])
    firsts = (
        with_slices(df, group, position, large, "inner")
        .groupBy(*[F.col(g).alias(f"_g_{g}") for g in group], "_slice")
        .agg(F.min(row).alias("_row"))
    )
    before = F.lag("_slice").over(
        Window.partitionBy(*[f"_g_{g}" for g in group]).orderBy("_slice")
    )
    guests = (
        firsts.withColumn("_slice", before)
        .filter(F.col("_slice").isNotNull())
        .select(*[F.col("_row")[c].alias(c) for c in columns], "_slice", F.lit(True).alias("_guest"))
    )
    rows = with_slices(df, group, position, large, "left").withColumn("_guest", F.lit(False))
    # the same order as that of the copied rows; of equal rows the copy comes last
    ahead = Window.partitionBy(*group, "_slice").orderBy("_guest", *ordered)
    leads = [F.lead(v).over(ahead).alias(name) for name, v in values.items()]
    return rows.unionByName(guests).select("*", *leads).filter(~F.col("_guest")).drop(
        "_slice", "_guest"
    )
