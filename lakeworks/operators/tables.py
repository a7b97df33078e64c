"""Table changes as pure DataFrame to DataFrame operators.

Plain Parquet tables have no row-level updates; each change gives the new
content, which :mod:`lakeworks.operators.storage` writes as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators.joins import sized_lookup


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the shape of a table: columns matched by name in any case, cast,
    absent ones NULL, surplus ones left out."""
    have: dict[str, str] = {}
    for column in rows.columns:
        if column.lower() in have:
            raise ValueError(f"columns {have[column.lower()]!r} and {column!r} differ only in case")
        have[column.lower()] = column
    chosen = []
    for field in schema:
        source = have.get(field.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        chosen.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*chosen)


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Target rows followed by new ones, matched by column name; absent columns NULL."""
    return target.unionByName(conform(rows, target.schema))


def update_where(df: DataFrame, condition: Column, **assignments: Column) -> DataFrame:
    """Set columns on the rows meeting the condition; NULL conditions leave a row alone."""
    values = {
        name: F.when(condition, value).otherwise(F.col(name)).cast(df.schema[name].dataType)
        for name, value in assignments.items()
    }
    return df.select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows not meeting the condition; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def _one_per_key(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Source with unique keys, so that a match never multiplies target rows.

    Among several source rows of a key the smallest combination of values wins,
    which keeps a recomputed task in line with the first run.
    """
    usable = source
    for key in keys:
        usable = usable.filter(F.col(key).isNotNull())
    picked = usable.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_new"))
    return picked.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_new")


def update_from(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Set columns from the source row with equal keys; NULL keys never match.

    A matched row takes the source value even where that is NULL.
    """
    new = _one_per_key(source, keys, columns)
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(key) == F.col(f"_k_{key}"))
    joined = target.join(new, match, "left")
    matched = F.col("_new").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def merge_update(
    target: DataFrame, source: DataFrame, on: dict[str, str], **assignments: Column
) -> DataFrame:
    """Set columns of target rows that have a source match.

    ``on`` maps target keys to source keys; assigned values may only use target columns.
    """
    keys = source.select(*[F.col(s).alias(f"_k_{t}") for t, s in on.items()]).distinct()
    keys = keys.withColumn("_hit", F.lit(True))
    match = F.lit(True)
    for key in on:
        match = match & (F.col(key) == F.col(f"_k_{key}"))
    joined = target.join(keys, match, "left")
    values = {
        name: F.when(F.col("_hit"), value).otherwise(F.col(name)) for name, value in assignments.items()
    }
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])


def rows_to_insert(target: DataFrame, source: DataFrame, on: dict[str, str]) -> DataFrame:
    """Source rows without a match in the target.

    Repeats within the source are all new; a NULL key never matches, so such a
    row is new every time.
    """
    keys = target.select(*[F.col(t).alias(f"_k_{s}") for t, s in on.items()])
    match = F.lit(True)
    for key in on.values():
        match = match & (F.col(key) == F.col(f"_k_{key}"))
    return source.join(keys, match, "left_anti")


def merge_insert(target: DataFrame, source: DataFrame, on: dict[str, str]) -> DataFrame:
    """Target plus the source rows it lacks; running it twice adds nothing."""
    return append(target, rows_to_insert(target, source, on))


def add_column(df: DataFrame, name: str, as_type: str, default: object = None) -> DataFrame:
    """New column holding its default in the existing rows."""
    return df.withColumn(name, F.lit(default).cast(as_type))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename; unlike ``withColumnRenamed`` a missing column is an error."""
    if old not in df.columns:
        raise ValueError(f"no column {old!r}")
    return df.withColumnRenamed(old, new)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Drop; unlike ``DataFrame.drop`` a missing column is an error."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r}")
    return df.drop(name)


def fill_defaults(rows: DataFrame, **defaults: Column) -> DataFrame:
    """Defaults for columns the new rows leave out; a NULL that a row states is kept."""
    return rows.withColumns({name: default for name, default in defaults.items() if name not in rows.columns})


def fill_nulls(rows: DataFrame, **values: Column) -> DataFrame:
    """Values in place of NULLs, for columns that must not have any."""
    return rows.withColumns({name: F.coalesce(F.col(name), value) for name, value in values.items()})


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.limit(0)


def with_sequence(rows: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Unique increasing key from ``start`` on, with gaps, as a sequence gives.

    No shuffle and no counting: each partition numbers its rows in its own
    range.  Write the result before using it twice.
    """
    return rows.select((F.monotonically_increasing_id() + F.lit(start)).alias(name), "*")


def number_rows(rows: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Unique key without gaps.

    ``rows`` must give the same partitions each time it runs: read it from
    files, or pass it through :func:`lakeworks.session.cut_lineage` first.  Only
    the row counts of the partitions are put in order, never the rows.
    """
    tagged = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_at", 33)
    )
    counts = tagged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.col("_at") - F.shiftleft("_part", 33)
    # a partition the count has not seen, or seen shorter, means the two runs differ
    lost = F.raise_error(F.lit("number_rows: the rows changed between counting and numbering"))
    offset = F.when((F.col("_offset").isNull()) | (inside >= F.col("_n")), lost).otherwise(F.col("_offset"))
    return tagged.join(sized_lookup(offsets), "_part", "left").select(
        (inside + offset + F.lit(start)).cast("bigint").alias(name), *rows.columns
    )
