"""Joins whose small side is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions.network import PREFIX_BITS, ip_to_int, join_key

#: A measured lookup up to this many bytes is sent to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def explodes(df: DataFrame) -> bool:
    """True if the plan makes several rows of one, which the estimate does not see."""
    return "Generate " in df._jdf.queryExecution().optimizedPlan().toString()


def _value_bytes(field: T.StructField) -> Column:
    """Bytes of one value; nested values by their JSON text."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) * 2 + 32
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, from the lengths of their values."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _value_bytes(field)
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def auto_broadcast_bytes(df: DataFrame) -> int:
    """The session's own limit below which Spark broadcasts by itself."""
    text = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(text)


def sized_lookup(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``lookup``, to be broadcast only when its size is known to fit.

    Three outcomes.  Spark's estimate is below its own limit: left alone, Spark
    broadcasts it.  The estimate is larger (typical for lookups derived from a
    big table) or blind to an explode: the bytes of its values are added up, and
    the hint is set if they fit.  Otherwise the join is done by shuffle and adaptive execution
    splits skewed partitions, so a key holding a third of the facts is spread
    over tasks.
    """
    blind = explodes(lookup)
    if not blind and planned_bytes(lookup) <= auto_broadcast_bytes(lookup):
        return lookup
    if measured_bytes(lookup) <= max_bytes:
        return F.broadcast(lookup)
    return lookup.hint("merge") if blind else lookup


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts with a lookup table, broadcast after a size check."""
    return facts.join(sized_lookup(lookup, max_bytes), on, how)


def restrict_to_keys(facts: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Facts whose key is listed; never multiplies rows, whatever ``keys`` repeats."""
    return facts.join(sized_lookup(keys), on, "left_semi")


def with_range_buckets(
    ranges: DataFrame, start: str, end: str, bucket: str, bits: int = PREFIX_BITS
) -> DataFrame:
    """One row per range and bucket of ``2**bits`` values it touches.

    Disjoint ranges over 32-bit addresses give at most (ranges + 2**(32-bits)) rows.
    """
    first, last = F.shiftright(start, bits), F.shiftright(end, bits)
    return ranges.filter(F.col(start) <= F.col(end)).withColumn(
        bucket, F.explode(F.sequence(first, last))
    )


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: Column,
    start: str,
    end: str,
    bits: int = PREFIX_BITS,
    keep_bucket: bool = False,
) -> DataFrame:
    """All pairs with ``start <= point <= end``, as a hash join on coarse buckets.

    ``point``, ``start`` and ``end`` are non-negative bigints.  A pair meets in
    exactly one bucket, the one of the point, so overlapping and very wide
    ranges need no special case and no pair repeats.
    """
    # NULL becomes -1, which no range holds; a nullable key would be computed
    # once more for the IS NOT NULL filter Spark derives from it
    keyed = points.withColumn("_point", F.coalesce(point, F.lit(-1))).withColumn(
        "_bucket", F.shiftright("_point", bits)
    )
    buckets = with_range_buckets(ranges, start, end, "_bucket", bits)
    joined = keyed.join(sized_lookup(buckets), "_bucket").filter(
        F.col("_point").between(F.col(start), F.col(end))
    )
    return joined.drop("_point") if keep_bucket else joined.drop("_point", "_bucket")


#: Levels of a cover lie so many bits apart.
COVER_STEP = 4


def with_cover(ranges: DataFrame, start: str, end: str, level: str, block: str, step: int = COVER_STEP) -> DataFrame:
    """One row per aligned block of a range: ``block`` counts blocks of ``2**level`` values.

    The blocks of a range are disjoint, fill it exactly and are as large as
    alignment allows, so there are at most ``2 * (2**step - 1)`` at each level, and
    with ``step=1`` at most two.  Only every ``step``-th level is used.  Bounds are
    bigints from 0 to 2**62; other ranges and empty ones have no blocks.
    """
    one = F.lit(1).cast("bigint")
    first, last = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    top = F.floor(F.log2((last - first + 1).cast("double"))).cast("int")
    valid = ranges.filter((first >= 0) & (first <= last) & (last <= (1 << 62)))
    leveled = valid.withColumn(level, F.explode(F.sequence(F.lit(0), F.greatest(top, F.lit(0)), F.lit(step))))

    def inside(shift: Column) -> tuple[Column, Column]:
        """First and last whole block of this level inside the range."""
        size = F.call_function("shiftleft", one, shift)
        low = F.call_function("shiftright", first + size - 1, shift)
        return low, F.call_function("shiftright", last + 1, shift) - 1

    low, high = inside(F.col(level))
    parent_low, parent_high = inside(F.col(level) + step)
    parent = (F.col(level) + step <= 62) & (parent_low <= parent_high)
    left_end = F.when(parent, F.least(high, F.shiftleft(parent_low, step) - 1)).otherwise(high)
    right_start = F.when(parent, F.greatest(low, F.shiftleft(parent_high + 1, step)))

    def listed(a: Column, z: Column) -> Column:
        return F.when(a <= z, F.sequence(a, z)).otherwise(F.array().cast("array<bigint>"))

    return leveled.withColumn(block, F.explode(F.concat(listed(low, left_end), listed(right_start, high))))


def cover_join(
    points: DataFrame, ranges: DataFrame, point: Column, start: str, end: str, step: int = COVER_STEP
) -> DataFrame:
    """All pairs with ``start <= point <= end``, as a hash join without a residual condition.

    Every range is cut into aligned blocks; a point is tried once for each level
    that occurs, at most ``64 / step`` times, and meets a range in exactly one of its
    blocks.  Wide and narrow ranges mix freely, and many narrow ranges close to
    each other share no bucket.  The levels are the only thing the driver sees.
    """
    cover = with_cover(ranges, start, end, "_level", "_block", step)
    levels = sorted(r["_level"] for r in cover.select("_level").distinct().collect()) or [0]
    # NULL becomes -1, which lies in no block
    tried = points.withColumn("_point", F.coalesce(point.cast("bigint"), F.lit(-1)))
    tries = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright("_point", k).alias("_block")) for k in levels])
    tried = tried.withColumn("_try", F.explode(tries)).select(*points.columns, "_try._level", "_try._block")
    return tried.join(sized_lookup(cover), ["_level", "_block"]).drop("_level", "_block")


def ip_range_join(logs: DataFrame, locations: DataFrame, ip: str = "ip_address") -> DataFrame:
    """Logs with the location whose address range holds their IP."""
    return cover_join(logs, locations, ip_to_int(ip), "start_ip_int", "end_ip_int")


def with_join_keys(locations: DataFrame, bits: int = PREFIX_BITS) -> DataFrame:
    """Location table prepared for :func:`keyed_ip_join`; store it once, reuse it."""
    return with_range_buckets(locations, "start_ip_int", "end_ip_int", "join_key", bits)


def keyed_ip_join(
    logs: DataFrame, keyed_locations: DataFrame, ip: str = "ip_address", bits: int = PREFIX_BITS
) -> DataFrame:
    """Range join on a location table that carries a ``join_key`` column."""
    value = F.coalesce(ip_to_int(ip), F.lit(-1))  # as in range_join
    keyed = logs.withColumn("_ip_int", value).withColumn("join_key", join_key("_ip_int", bits))
    return (
        keyed.join(sized_lookup(keyed_locations), "join_key")
        .filter(F.col("_ip_int").between(F.col("start_ip_int"), F.col("end_ip_int")))
        .drop("_ip_int", "join_key")
    )


def every_combination(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """Each left row with each right row.

    Planned as an equality join: left rows are dealt over ``spread`` salts, as
    many as the session has shuffle partitions, and the right side is repeated
    once per salt.  No task sees more than its share
    of the left side, and neither side has to fit in memory.
    """
    spread = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))
    # the partition number keeps equal rows from all meeting in one salt
    dealt = left.withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(spread))
    )
    repeated = right.withColumn("_salt", F.explode(salts))
    return dealt.join(sized_lookup(repeated), "_salt").drop("_salt")
