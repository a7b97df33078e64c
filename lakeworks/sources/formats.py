"""Delimited text: named formats and readers."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.sources.files import with_row_numbers
from lakeworks.sources.spans import spans, switches


@dataclass(frozen=True)
class Format:
    """How a delimited file is cut into fields and records."""

    sep: str = ","
    record: str | None = None  # None: any of \n, \r\n, \r
    quote: str | None = None
    trim: bool = False
    header_rows: int = 0
    #: Quoted fields may hold the end of a record.
    breaks_in_quotes: bool = False

    def options(self) -> dict[str, str]:
        options = {
            "sep": self.sep,
            "quote": self.quote or "",
            "ignoreLeadingWhiteSpace": str(self.trim).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim).lower(),
        }
        if self.quote:
            options["escape"] = self.quote
        if self.record:
            options["lineSep"] = self.record
        return options


#: Comma, one header row.
COMMA = Format(header_rows=1)
#: Comma, one header row, fields optionally in double quotes, trimmed.
COMMA_QUOTED = Format(quote='"', trim=True, header_rows=1)
#: Pipe, one header row.
PIPE = Format(sep="|", header_rows=1)
#: Pipe, records ended by a carriage return, optional double quotes.
PIPE_CR = Format(sep="|", record="\r", quote='"', header_rows=1)
#: Tab, one header row, trimmed.
TAB = Format(sep="\t", trim=True, header_rows=1)
#: Fields by ``=``, records by ``^``.
EQUALS_CARET = Format(sep="=", record="^", trim=True)
#: One field per record, records by ``;``.
SEMICOLON_RECORDS = Format(sep="\x01", record=";", trim=True)
#: Fields by pipe, records by ``;``.
PIPE_SEMICOLON = Format(sep="|", record=";", trim=True)
#: Percent sign, two header rows, trimmed.
PERCENT_TWO_HEADERS = Format(sep="%", trim=True, header_rows=2)

#: Column that holds a record which does not fit the schema.
BAD_RECORD = "bad_record"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    fmt: Format = COMMA,
    schema: str | T.StructType | None = None,
    on_error: str = "permit",
) -> DataFrame:
    """Delimited files to a DataFrame.

    Without a schema all columns are text, named by the header or ``_c0``...
    ``on_error``: ``permit`` turns unreadable fields into NULL, ``abort`` fails
    the job, ``report`` returns only the unreadable records with the record
    text in ``bad_record``.

    Files whose quoted fields hold line breaks (``breaks_in_quotes``) are read in
    pieces all the same; they need a schema.
    """
    if fmt.breaks_in_quotes:
        if schema is None or not fmt.quote:
            raise ValueError("quoted line breaks need a quote and a schema")
        return _read_across_lines(spark, path, fmt, schema, on_error)
    if fmt.header_rows > 1:
        if schema is None or on_error == "report":
            raise ValueError("several header rows need a schema and no error report")
        return _read_skipping(spark, path, fmt, schema, on_error)
    reader = spark.read.options(**fmt.options()).option("header", fmt.header_rows == 1)
    if schema is None:
        return reader.csv(path)
    wanted = _as_struct(schema)
    if on_error == "report":
        wider = T.StructType([*wanted.fields, T.StructField(BAD_RECORD, T.StringType())])
        found = (
            reader.schema(wider)
            .option("enforceSchema", True)
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            .csv(path)
        )
        return _all_fields_read(found).filter(F.col(BAD_RECORD).isNotNull())
    if on_error == "abort":
        return _all_fields_read(reader.schema(wanted).option("mode", "FAILFAST").csv(path))
    return reader.schema(wanted).csv(path)


def _all_fields_read(df: DataFrame) -> DataFrame:
    """Keep every column in the scan, whichever a caller goes on to use.

    Column pruning would leave fields unparsed, and a record is bad because of
    any of its fields.  The condition holds for every row.
    """
    return df.filter(F.hash(*df.columns) >= F.lit(-(2**31)))


def _as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _read_skipping(
    spark: SparkSession,
    path: str | list[str],
    fmt: Format,
    schema: str | T.StructType,
    on_error: str,
) -> DataFrame:
    """Drop the first ``header_rows`` records of every file, then parse the rest."""
    lines = with_row_numbers(read_lines(spark, path, fmt.record))
    body = lines.filter((F.col("file_row") > fmt.header_rows) & (F.trim("value") != ""))
    wanted = _as_struct(schema)
    options = {k: v for k, v in fmt.options().items() if k != "lineSep"}
    options["mode"] = "FAILFAST" if on_error == "abort" else "PERMISSIVE"
    parsed = F.from_csv("value", wanted.simpleString()[len("struct<"):-1].replace(":", " "), options)
    rows = body.select(parsed.alias("r")).select("r.*")
    return _all_fields_read(rows) if on_error == "abort" else rows


def read_records(spark: SparkSession, path: str | list[str], fmt: Format) -> DataFrame:
    """Records of delimited files as text, their quoted line breaks kept: file_path, file_name, number (from 0), value.

    The quote character doubled inside a field switches twice, so the number of
    quotes in a line tells whether it opens or closes a field.
    """
    separator = fmt.record or "\n"
    lines = spark.read.option("lineSep", separator).text(path)
    found = spans(lines, separator, switches(F.col("value"), fmt.quote))
    return found.select("file_path", "file_name", "number", "value")


def _read_across_lines(
    spark: SparkSession, path: str | list[str], fmt: Format, schema: str | T.StructType, on_error: str
) -> DataFrame:
    """Records that may span lines, parsed one by one; header records are dropped from every file."""
    records = read_records(spark, path, fmt).filter(F.col("number") >= fmt.header_rows)
    value = F.col("value") if fmt.record else F.regexp_replace("value", r"\r\z", "")
    body = records.select(value.alias("value")).filter(F.trim("value") != "")
    wanted = _as_struct(schema)
    options = {k: v for k, v in fmt.options().items() if k != "lineSep"}
    options["mode"] = "FAILFAST" if on_error == "abort" else "PERMISSIVE"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields]
    if on_error == "report":
        fields.append(f"{BAD_RECORD} string")
        options["columnNameOfCorruptRecord"] = BAD_RECORD
    rows = body.select(F.from_csv("value", ", ".join(fields), options).alias("r")).select("r.*")
    if on_error == "report":
        return rows.filter(F.col(BAD_RECORD).isNotNull())
    return _all_fields_read(rows) if on_error == "abort" else rows


def read_lines(
    spark: SparkSession, path: str | list[str], record: str | None = None
) -> DataFrame:
    """Raw records, one text column ``value``."""
    reader = spark.read
    if record:
        reader = reader.option("lineSep", record)
    return reader.text(path)


def read_positional(
    spark: SparkSession, path: str | list[str], fmt: Format, fields: dict[str, int], width: int
) -> DataFrame:
    """Columns by 1-based position: ``{"id": 2, "name": 1}`` swaps the first two."""
    names = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = read_delimited(spark, path, fmt, schema)
    return rows.select(*[F.col(names[at - 1]).alias(name) for name, at in fields.items()])


def read_by_name(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: Format = COMMA_QUOTED
) -> DataFrame:
    """Files with a header, loaded into a wider table by column name in any case."""
    from lakeworks.operators.tables import conform

    return conform(read_delimited(spark, path, replace(fmt, header_rows=1)), schema)


def without_line_breaks(value: Column) -> Column:
    """Remove CR LF pairs left inside a field when records end in another character."""
    return F.replace(value, F.lit("\r\n"), F.lit(""))
