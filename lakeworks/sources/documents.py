"""JSON files as variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.session import cut_lineage
from lakeworks.sources.files import with_row_numbers
from lakeworks.sources.spans import spans, switches

#: Files up to this size are parsed whole by one task; larger ones are cut into elements by many.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
#: What may stand before the first value of a file: white space and a byte order mark.
LEADING = r"^[\s\uFEFF]*"


def read_json_array(
    spark: SparkSession,
    path: str | list[str],
    as_name: str = "raw",
    numbered: bool = False,
    on_error: str = "abort",
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """One variant per element of each file's outer array, JSON nulls kept.

    Files of single objects or of one object per line work as well.  With
    ``numbered`` the columns ``file_name`` and the 1-based ``file_row`` come
    along.  ``on_error="skip"`` leaves out files that are not JSON, ``"abort"``
    fails the job.

    A file up to ``whole_file_bytes`` is parsed by one task.  A larger one is read
    in byte ranges: an array is cut into its elements, so that only an element must
    fit a task; any other large file is read as one value a line.
    """
    size = F.col("_metadata.file_size")
    texts = spark.read.text(path, wholetext=True).filter(size <= whole_file_bytes)
    each = F.posexplode(file_values(F.col("value"), on_error)).alias("_pos", as_name)
    rows = texts.select(F.col("_metadata.file_name").alias("file_name"), each).select(
        "file_name", (F.col("_pos") + 1).cast("bigint").alias("file_row"), as_name
    )
    listing = spark.read.format("binaryFile").load(path).select("length")  # the contents are not read
    if not listing.filter(F.col("length") > whole_file_bytes).isEmpty():
        rows = rows.unionByName(_large_files(spark, path, as_name, on_error, whole_file_bytes))
    return rows if numbered else rows.select(as_name)


def json_spans(pieces: DataFrame) -> DataFrame:
    """Elements of outer arrays as text, from files read with a comma as separator.

    A backslash occurs only inside strings and takes the next character with it, so
    what is left of a piece without such pairs has only quotes that count.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")

    def rise(text: Column) -> Column:
        outside = F.regexp_replace(text, r'(?s)"[^"]*("|\z)', "")
        return F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))

    return spans(pieces, ",", switches(bare), (rise(bare), rise(F.concat(F.lit('"'), bare))), level=1, opening=_opening())


def _opening() -> Column:
    """The first character of a piece that is not blank."""
    return F.regexp_extract("value", LEADING + r"(\S)", 1)


def _large_files(spark: SparkSession, path: str | list[str], as_name: str, on_error: str, above: int) -> DataFrame:
    """file_name, file_row and a variant of each value in the files larger than ``above`` bytes."""
    large = F.col("_metadata.file_size") > above
    pieces = spark.read.option("lineSep", ",").text(path).filter(large)
    found = json_spans(pieces)
    whole = (F.col("opening") == "[") & ~F.col("end_quoted") & (F.col("end_depth") == 0)
    text = F.when(F.col("number") == 0, F.regexp_replace("value", LEADING + r"\[", "")).otherwise(F.col("value"))
    text = F.when(F.col("number") == F.col("n_ends"), F.regexp_replace(text, r"\]\s*\z", "")).otherwise(text)
    elements_ = found.filter("opening = '['").withColumn("_text", text)
    # an array without elements leaves one blank text
    elements_ = elements_.filter((F.col("n_ends") > 0) | (F.trim(F.translate("_text", "\r\n\t", "   ")) != ""))
    # files of another kind are known by their beginning; as a rule there are none
    starts = pieces.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_start"), _opening().alias("_opening"), F.monotonically_increasing_id().alias("_at"))
    others = starts.filter("_start = 0").groupBy("file_path").agg(F.min_by("_opening", "_at").alias("_opening"))
    others = cut_lineage(others.filter("_opening <> '['").select("file_path"), "others")
    any_others = not others.isEmpty()
    lines = with_row_numbers(spark.read.text(path).filter(large).withColumn("file_path", F.col("_metadata.file_path")))
    lines = lines.join(others, "file_path", "left_semi").filter(F.trim("value") != "")
    if on_error == "abort":
        broken = F.raise_error(F.concat(F.lit("not a whole JSON array: "), "file_name")).cast("string")
        checked = F.when(whole, F.col("_text")).otherwise(broken)
        arrays = elements_.select("file_name", (F.col("number") + 1).alias("file_row"), F.parse_json(checked).alias(as_name))
        return arrays.unionByName(lines.select("file_name", "file_row", F.parse_json("value").alias(as_name))) if any_others else arrays
    parsed = elements_.select("file_path", "file_name", (F.col("number") + 1).alias("file_row"), F.try_parse_json("_text").alias(as_name), whole.alias("_whole"))
    bad = parsed.groupBy("file_path").agg(F.bool_or(F.col(as_name).isNull() | ~F.col("_whole")).alias("_bad")).filter("_bad").select("file_path")
    arrays = parsed.join(bad, "file_path", "left_anti").select("file_name", "file_row", as_name)
    if not any_others:
        return arrays
    values = lines.select("file_path", "file_name", "file_row", F.try_parse_json("value").alias(as_name))
    unread = values.groupBy("file_path").agg(F.bool_or(F.col(as_name).isNull()).alias("_bad")).filter("_bad").select("file_path")
    return arrays.unionByName(values.join(unread, "file_path", "left_anti").select("file_name", "file_row", as_name))


def read_json_document(
    spark: SparkSession, path: str | list[str], as_name: str = "whole_object"
) -> DataFrame:
    """One variant per file, such as a GeoJSON feature collection."""
    return spark.read.option("multiLine", True).option("singleVariantColumn", as_name).json(path)


def read_json_lines(
    spark: SparkSession, path: str | list[str], as_name: str = "raw"
) -> DataFrame:
    """One variant per line; large files are read in pieces."""
    return spark.read.option("singleVariantColumn", as_name).json(path)


def elements(document: Column) -> Column:
    """Elements of an array document; any other document is its only element."""
    return F.coalesce(F.try_variant_get(document, "$", "array<variant>"), F.array(document))


def file_values(text: Column, on_error: str = "skip") -> Column:
    """Array of variants from the text of a whole file; NULL if it is not JSON.

    The file may hold an array, an object, or several of them on lines of their
    own.  The JSON parser stops after the first value of a text, so several
    values are made into one array first: a closing and an opening bracket with
    only a line break between them occur nowhere inside valid JSON.  A file of
    one array is parsed element by element, so the size limit of a variant holds
    for an element and not for the file.
    """
    options = {"mode": "FAILFAST" if on_error == "abort" else "PERMISSIVE"}
    listed = F.regexp_replace(text, r"([}\]])\s*\n\s*([{\[])", "$1,$2")
    whole = F.concat(F.lit("["), listed, F.lit("]"))
    documents = F.from_json(whole, "array<variant>", options)
    one_array = (F.length(listed) == F.length(text)) & text.rlike(LEADING + r"\[")
    return F.when(one_array, F.from_json(F.regexp_replace(text, LEADING, ""), "array<variant>", options)).otherwise(
        F.flatten(F.transform(documents, elements))
    )


def rejected_files(files: DataFrame) -> DataFrame:
    """Files of whole-file texts (batch or stream) that are not JSON: file_name, file_path, text.

    A blank file holds no value and is not rejected.
    """
    return files.select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"), "value"
    ).filter(file_values(F.col("value")).isNull() & (F.trim("value") != "")).withColumnRenamed("value", "text")


def split_json_lines(lines: DataFrame, as_name: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Lines of text files as variants, and the lines that are not JSON.

    Both carry ``file_name``.  Files are read in pieces and a bad line costs
    only itself.
    """
    named = lines.select(F.col("_metadata.file_name").alias("file_name"), F.trim("value").alias("line")).filter("line != ''")
    parsed = named.withColumn(as_name, F.try_parse_json("line"))
    good = parsed.filter(F.col(as_name).isNotNull()).select("file_name", as_name)
    return good, parsed.filter(F.col(as_name).isNull()).select("file_name", "line")
