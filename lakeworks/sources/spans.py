"""Records that a byte range cannot end by itself: quoted line breaks, elements of one array.

A large file is read in byte ranges, taken in stretches of a bounded number of pieces,
and a stretch does not know whether it starts inside a quoted field or how deep it is nested.  The text source cuts the ranges at
a separator; for every piece between two separators it is known from its own text
whether it switches quoting, and by how much it rises if it starts outside or inside
of quotes.  These changes are added up by stretch, combined over the stretches of a file
in order, and carried back into the pieces.  A separator ends a record if it lies
outside of quotes at the record's level.

Two passes read the marks of the pieces, a few bytes each; the third moves the text
once, to put records together within their stretch.  Only records that reach over the
end of a stretch are put together across stretches.  The rows that are moved name their
file by a number; names are added to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.joins import sized_lookup
from lakeworks.session import cut_lineage

_RANGE = ["_file", "_start", "_stretch"]
#: Pieces of a stretch at most, as a power of two: what a task orders and holds at a time.
STRETCH_BITS = 16


def switches(text: Column, quote: str = '"') -> Column:
    """1 if the text holds an odd number of quotes."""
    return F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit("")))


def spans(
    pieces: DataFrame,
    separator: str,
    quotes: Column,
    rises: tuple[Column, Column] | None = None,
    level: int = 0,
    opening: Column | None = None,
) -> DataFrame:
    """Records of files read in pieces (``spark.read.option("lineSep", separator).text``).

    ``quotes`` is the number of quotes in a piece, ``rises`` the change of depth if
    the piece starts outside and if it starts inside of quotes.  Returns file_path,
    file_name, number (from 0), value, n_ends (separators that end a record in the
    file), end_quoted and end_depth (at the end of the file), and opening (of the
    file's first piece).

    ``pieces`` must be a plain file read, cut the same way each time it runs; if it
    is not, the job fails.  A file of no bytes has no records.
    """
    outside, inside = rises or (F.lit(0), F.lit(0))
    tagged = pieces.select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
        (quotes % 2).cast("int").alias("_odd"),
        outside.cast("long").alias("_outside"),
        inside.cast("long").alias("_inside"),
        (F.lit(None).cast("string") if opening is None else opening).alias("_opening"),
    ).withColumn("_stretch", F.shiftright("_at", STRETCH_BITS))
    path, name = F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")
    listed = pieces.select(path, name).distinct().groupBy(F.xxhash64("file_path").alias("_file")).agg(
        F.count("*").alias("_n"), F.min("file_path").alias("file_path"), F.min("file_name").alias("file_name")
    )
    twice = F.raise_error(F.lit("spans: two files have one number")).cast("string")
    listed = listed.withColumn("file_path", F.when(F.col("_n") == 1, F.col("file_path")).otherwise(twice)).drop("_n")
    in_range = Window.partitionBy(*_RANGE).orderBy("_at")
    upto, before = in_range.rowsBetween(Window.unboundedPreceding, 0), in_range.rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = Window.partitionBy("_file").orderBy("_start", "_stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("_file")

    def earlier(name: str, window: Window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    # what each stretch does, for both states it may start in
    marks = tagged.drop("value")
    changes = (
        marks.withColumn("_turned", earlier("_odd", before) % 2)
        .groupBy(*_RANGE)
        .agg(
            F.count("*").alias("_pieces"),
            (F.sum("_odd") % 2).alias("_odd"),
            F.sum(F.when(F.col("_turned") == 0, F.col("_outside")).otherwise(F.col("_inside"))).alias("_outside"),
            F.sum(F.when(F.col("_turned") == 0, F.col("_inside")).otherwise(F.col("_outside"))).alias("_inside"),
            F.min_by("_opening", "_at").alias("_opening"),
        )
    )
    entered = changes.withColumn("_quoted", earlier("_odd", ranges_before) % 2).withColumn(
        "_rise", F.when(F.col("_quoted") == 0, F.col("_outside")).otherwise(F.col("_inside"))
    )
    states = cut_lineage(
        entered.select(
            *_RANGE,
            "_pieces",
            "_quoted",
            earlier("_rise", ranges_before).alias("_depth"),
            (F.sum("_odd").over(whole_file) % 2 == 1).alias("end_quoted"),
            F.sum("_rise").over(whole_file).alias("end_depth"),
            F.min_by("_opening", F.struct("_start", "_stretch")).over(whole_file).alias("opening"),
        ),
        "ranges",
    )

    def with_ends(rows: DataFrame, found: DataFrame) -> DataFrame:
        """Adds ``_ends``, 1 if the separator after the piece ends a record."""
        joined = rows.join(sized_lookup(found), _RANGE, "left")
        known = F.count("*").over(in_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == F.col("_pieces")
        lost = F.raise_error(F.lit("spans: the files were read in other pieces when they were counted"))
        state = (F.col("_quoted") + earlier("_odd", before)) % 2
        joined = joined.withColumn("_state", F.when(F.coalesce(known, F.lit(False)), state).otherwise(lost.cast("long")))
        joined = joined.withColumn("_rise", F.when(F.col("_state") == 0, F.col("_outside")).otherwise(F.col("_inside")))
        outside_after = (F.col("_state") + F.col("_odd")) % 2 == 0
        return joined.withColumn("_ends", (outside_after & (F.col("_depth") + F.sum("_rise").over(upto) == level)).cast("int"))

    known = states.select(*_RANGE, "_pieces", "_quoted", "_depth")
    ends = with_ends(marks.drop("_opening"), known).groupBy(*_RANGE).agg(F.sum("_ends").cast("long").alias("_range_ends"))
    states = cut_lineage(
        states.join(ends, _RANGE)
        .withColumn("_earlier", earlier("_range_ends", ranges_before))
        .withColumn("n_ends", F.sum("_range_ends").over(whole_file)),
        "ranges",
    )
    known = states.select(*_RANGE, "_pieces", "_quoted", "_depth", "_earlier", "_range_ends")
    numbered = with_ends(tagged.drop("_opening"), known).withColumn("_local", earlier("_ends", before))
    parts = numbered.groupBy(*_RANGE, "_local").agg(
        F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("_pieces"),
        F.first("_earlier").alias("_earlier"),
        F.first("_range_ends").alias("_range_ends"),
    )
    parts = parts.select(
        *_RANGE,
        (F.col("_earlier") + F.col("_local")).alias("number"),
        F.array_join(F.transform("_pieces", lambda p: p["value"]), separator).alias("value"),
        ((F.col("_local") == 0) | (F.col("_local") == F.col("_range_ends"))).alias("_cut"),
    )
    across = parts.filter("_cut").groupBy("_file", "number").agg(
        F.array_sort(F.collect_list(F.struct("_start", "_stretch", "value"))).alias("_parts")
    )
    across = across.select("_file", "number", F.array_join(F.transform("_parts", lambda p: p["value"]), separator).alias("value"))
    records = parts.filter("NOT _cut").select("_file", "number", "value").unionByName(across)
    of_file = states.select("_file", "n_ends", "end_quoted", "end_depth", "opening").distinct()
    of_file = cut_lineage(of_file.join(listed, "_file"), "files")
    return records.join(sized_lookup(of_file), "_file").select(
        "file_path", "file_name", "number", "value", "n_ends", "end_quoted", "end_depth", "opening"
    )
