"""Local time, time of day and boundary-counting differences.

Everything works on ``timestamp_ntz`` so that no result depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.sources.tables import literal_rows

# Name of each hour of the day.
TIME_OF_DAY = (
    (0, "Late at night"),
    (1, "Late at night"),
    (2, "Late at night"),
    (3, "Toward morning"),
    (4, "Toward morning"),
    (5, "Toward morning"),
    (6, "Early morning"),
    (7, "Early morning"),
    (8, "Early morning"),
    (9, "Mid-morning"),
    (10, "Mid-morning"),
    (11, "Late morning"),
    (12, "Late morning"),
    (13, "Early afternoon"),
    (14, "Early afternoon"),
    (15, "Mid-afternoon"),
    (16, "Mid-afternoon"),
    (17, "Late afternoon"),
    (18, "Late afternoon"),
    (19, "Early evening"),
    (20, "Early evening"),
    (21, "Late evening"),
    (22, "Late evening"),
    (23, "Late evening"),
)


def time_of_day_lookup(spark: SparkSession) -> DataFrame:
    """The 24-row lookup ``(hour, tod_name)`` as literal rows."""
    return literal_rows(spark, TIME_OF_DAY, hour="int", tod_name="string")


def to_local(ts: Column, zone: Column, source: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` (which may differ per row)."""
    return F.convert_timezone(F.lit(source), zone, ts)


def minutes_between(start: str, end: str) -> Column:
    """Minute boundaries crossed from column ``start`` to column ``end``.

    10:00:59 to 10:01:00 is 1, unlike elapsed whole minutes.
    """
    return F.expr(
        f"CAST(datediff({end}, {start}) AS BIGINT) * 1440"
        f" + (hour({end}) - hour({start})) * 60 + minute({end}) - minute({start})"
    )


def second_index(ts: str) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock column, never decreasing in ``ts``."""
    return F.expr(
        f"CAST(datediff({ts}, DATE'1970-01-01') AS BIGINT) * 86400"
        f" + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
    )


def load_second() -> Column:
    """Time of the load, cut to the second."""
    return F.date_trunc("second", F.current_timestamp())
