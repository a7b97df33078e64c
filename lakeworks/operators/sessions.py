"""Event-to-event session lengths and their time-of-day grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.temporal import minutes_between, second_index
from lakeworks.operators.ordering import GROUP_ROWS, with_next

# Upper bounds in minutes (exclusive) and bucket names.
LENGTH_BUCKETS = (
    (10, "< 10 mins"),
    (20, "10 to 19 mins"),
    (30, "20 to 29 mins"),
    (40, "30 to 39 mins"),
)
LONGEST_BUCKET = "> 40 mins"


def with_logout(
    events: DataFrame,
    gamer: str = "gamer_name",
    at: str = "game_event_ltz",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Pair every event with the gamer's next one.

    ``logout`` is NULL for the last event, whose length is 0.  Every event is
    paired, so the gap after a logout counts like a session.
    """
    paired = with_next(
        events, [gamer], at, {"logout": at}, second_index(at), group_rows=group_rows
    )
    gap = minutes_between(at, "logout")
    return paired.withColumn("game_session_length", F.coalesce(gap, F.lit(0)))


def session_lengths(events: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Login, logout and minutes per event, longest first.

    The extra sort columns let a global sort cut the many equal lengths apart.
    """
    slim = events.select("gamer_name", "game_event_ltz")
    return (
        with_logout(slim, group_rows=group_rows)
        .select("gamer_name", F.col("game_event_ltz").alias("login"), "logout", "game_session_length")
        .orderBy(F.desc("game_session_length"), "gamer_name", "login")
    )


def length_bucket(minutes: Column) -> Column:
    """Name of the length class; the last one holds 40 as well."""
    first, *rest = LENGTH_BUCKETS
    chosen = F.when(minutes < first[0], first[1])
    for bound, name in rest:
        chosen = chosen.when(minutes < bound, name)
    return chosen.otherwise(LONGEST_BUCKET)


def session_grid_rows(events: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Length class and time of day of every event that has a next one."""
    slim = events.select("gamer_name", "game_event_ltz", "tod_name")
    paired = with_logout(slim, group_rows=group_rows).filter(F.col("logout").isNotNull())
    return paired.select(
        length_bucket(F.col("game_session_length")).alias("session_length"), "tod_name"
    )


def session_grid(events: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Sessions per length class and time of day."""
    rows = session_grid_rows(events, group_rows)
    return rows.groupBy("session_length", "tod_name").agg(F.count("*").alias("n_sessions"))
