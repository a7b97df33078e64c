"""Game logs: variant rows to enriched events in the gamer's local time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.temporal import time_of_day_lookup, to_local
from lakeworks.functions.variants import path
from lakeworks.operators import aggregates, tables
from lakeworks.operators.joins import keyed_ip_join
from lakeworks.schemas import struct

#: Target keys of the merge and the columns of an enriched row they equal.
EVENT_KEY = {
    "gamer_name": "gamer_name",
    "game_event_utc": "game_event_utc",
    "game_event_name": "game_event_name",
}

#: Schema of the enriched table.
ENRICHED = struct(
    ip_address="string",
    gamer_name="string",
    game_event_name="string",
    game_event_utc="timestamp_ntz",
    city="string",
    region="string",
    country="string",
    gamer_ltz_name="string",
    game_event_ltz="timestamp_ntz",
    dow_name="string",
    tod_name="string",
)


def parse_logs(raw: DataFrame, log: str = "raw_log") -> DataFrame:
    """Typed columns of raw log variants; ``agent`` is kept for telling the feeds apart."""
    return raw.select(
        path(log, "agent").alias("agent"),
        path(log, "user_event").alias("user_event"),
        path(log, "datetime_iso8601", "timestamp_ntz").alias("datetime_iso8601"),
        path(log, "user_login").alias("user_login"),
        path(log, "game_id").alias("game_id"),
        path(log, "ip_address").alias("ip_address"),
    )


def with_address(logs: DataFrame) -> DataFrame:
    """Logs of the feed that carries addresses."""
    return logs.filter(F.col("ip_address").isNotNull())


def without_agent(logs: DataFrame) -> DataFrame:
    """Logs of the feed that no longer carries an agent."""
    return logs.filter(F.col("agent").isNull())


def of_player(logs: DataFrame, pattern: str) -> DataFrame:
    """Logs whose login matches a pattern, ignoring case."""
    return logs.filter(F.col("user_login").ilike(pattern))


def enhance(logs: DataFrame, keyed_locations: DataFrame) -> DataFrame:
    """Place, local time, weekday and time of day of every log whose address is known.

    ``keyed_locations`` comes from :func:`lakeworks.operators.joins.with_join_keys`.
    """
    located = keyed_ip_join(logs, keyed_locations)
    local = to_local(F.col("datetime_iso8601"), F.col("timezone"))
    # hour -1 is in no lookup; see range_join for why the key is not nullable
    hour = F.coalesce(F.hour("game_event_ltz"), F.lit(-1))
    timed = located.withColumn("game_event_ltz", local).withColumn("hour", hour)
    hours = F.broadcast(time_of_day_lookup(logs.sparkSession))  # 24 rows, always
    named = timed.join(hours, "hour")
    return named.select(
        "ip_address",
        F.col("user_login").alias("gamer_name"),
        F.col("user_event").alias("game_event_name"),
        F.col("datetime_iso8601").alias("game_event_utc"),
        "city",
        "region",
        "country",
        F.col("timezone").alias("gamer_ltz_name"),
        "game_event_ltz",
        F.dayname("game_event_ltz").alias("dow_name"),
        "tod_name",
    )


def merge_new(enriched: DataFrame, logs: DataFrame) -> DataFrame:
    """Enriched table plus the enriched logs it lacks."""
    return tables.merge_insert(enriched, logs, EVENT_KEY)


def mark_known(enriched: DataFrame, logs: DataFrame, **assignments: Column) -> DataFrame:
    """Set columns of enriched rows that stem from the given raw logs."""
    on = {
        "gamer_name": "user_login",
        "game_event_utc": "datetime_iso8601",
        "game_event_name": "user_event",
    }
    return tables.merge_update(enriched, logs, on, **assignments)


def login_and_logout(enriched: DataFrame) -> DataFrame:
    """All local event times of a gamer in one text, in time order."""
    at = F.col("game_event_ltz")
    return aggregates.ordered_text(
        enriched,
        ["gamer_name"],
        at.cast("string"),
        " / ",
        "login_and_logout",
        order=at,
        stretch=F.to_date(at),
    )


def hours_by_name(hours: DataFrame) -> DataFrame:
    """The hours of each time of day, as one text."""
    return aggregates.ordered_text(hours, ["tod_name"], F.col("hour"), ",", "hours")
