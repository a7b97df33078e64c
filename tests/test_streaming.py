from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakeworks.functions.network import ip_to_int
from lakeworks.operators.joins import with_join_keys
from lakeworks.plans import gamelogs
from lakeworks.streaming import pipeline


def log(login, minute, event="login", ip="10.1.2.3"):
    return {"user_login": login, "datetime_iso8601": f"2024-01-01 10:{minute:02d}:00.000", "user_event": event, "ip_address": ip}


class Lake:
    """One pipeline in a temporary folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "files").mkdir()
        loc = spark.createDataFrame(
            [("10.1.0.0", "10.1.255.255", "C", "R", "N", "Asia/Tokyo")],
            "a string, b string, city string, region string, country string, timezone string",
        )
        self.keyed = with_join_keys(
            loc.select("*", ip_to_int("a").alias("start_ip_int"), ip_to_int("b").alias("end_ip_int")).drop("a", "b")
        )

    def path(self, name):
        return str(self.folder / name)

    def drop(self, name, logs, as_lines=False):
        text = "\n".join(map(json.dumps, logs)) if as_lines else json.dumps(logs, indent=1)
        (self.folder / "files" / name).write_text(text)

    def ingest(self, **options):
        return pipeline.ingest_files(self.spark, self.path("files"), self.path("landing"), self.path("ck1"), **options)

    def merge(self):
        return pipeline.merge_changes(
            pipeline.changes(self.spark, self.path("landing")),
            self.enrich,
            self.path("target"),
            gamelogs.ENRICHED,
            gamelogs.EVENT_KEY,
            self.path("ck2"),
            prune_by="game_event_utc",
        )

    def enrich(self, rows):
        return gamelogs.enhance(rows, self.keyed)

    def run(self):
        pipeline.run_chain(self.ingest, self.merge)

    def landing(self):
        return self.spark.read.schema(pipeline.LANDING).parquet(self.path("landing"))

    def target(self):
        return pipeline.read_target(self.spark, self.path("target"), gamelogs.ENRICHED)

    def names(self):
        return sorted(r["gamer_name"] for r in self.target().collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_each_file_once_and_provenance(lake):
    lake.drop("a.json", [log("ann", 1), log("bob", 2)])
    lake.run()
    assert lake.names() == ["ann", "bob"]
    lake.run()  # nothing new
    assert lake.names() == ["ann", "bob"] and lake.landing().count() == 2
    lake.drop("b.json", [log("cat", 3), log("dan", 4, ip="99.0.0.1"), log("ann", 1)], as_lines=True)
    lake.run()
    assert lake.names() == ["ann", "bob", "cat"]  # unknown address lost, known event not added again
    rows = lake.landing().select("log_file_name", "log_file_row_id", "user_login").collect()
    assert sorted(tuple(r) for r in rows if r[0] == "b.json") == [("b.json", 1, "cat"), ("b.json", 2, "dan"), ("b.json", 3, "ann")]
    assert lake.landing().filter("load_ltz is null").count() == 0
    one = lake.target().filter("gamer_name = 'ann'").first()
    assert (str(one["game_event_ltz"]), one["dow_name"], one["tod_name"]) == ("2024-01-01 19:01:00", "Mon", "Early evening")


def test_no_batch_without_data(lake):
    lake.drop("a.json", [log("ann", 1)])
    lake.run()
    query = lake.merge()
    query.awaitTermination()
    assert not [p for p in query.recentProgress if p.numInputRows > 0]


def test_repeated_batch_gives_the_same_rows(lake):
    rows = lake.spark.createDataFrame(
        [("10.1.2.3", "ann", "login", 5), ("10.1.2.3", "bob", "login", 6)],
        "ip_address string, user_login string, user_event string, m int",
    ).withColumn("datetime_iso8601", F.expr("TIMESTAMP_NTZ'2024-01-01 10:00:00' + make_interval(0, 0, 0, 0, 0, m)"))
    enriched = lake.enrich(rows)
    args = (lake.path("target"), gamelogs.ENRICHED, gamelogs.EVENT_KEY)
    pipeline.insert_batch(enriched.filter("gamer_name = 'ann'"), *args, "run", 0, "game_event_utc")  # died half way
    pipeline.insert_batch(enriched, *args, "run", 0, "game_event_utc")  # tried again
    assert lake.names() == ["ann", "bob"]
    pipeline.insert_batch(enriched, *args, "run", 1, "game_event_utc")
    assert lake.names() == ["ann", "bob"]
    pipeline.insert_batch(enriched.limit(0), *args, "run", 2, "game_event_utc")
    assert lake.names() == ["ann", "bob"]


def test_lost_checkpoint_adds_nothing_twice(lake):
    lake.drop("a.json", [log("ann", 1)])
    lake.run()
    query = pipeline.merge_changes(
        pipeline.changes(lake.spark, lake.path("landing")), lake.enrich, lake.path("target"),
        gamelogs.ENRICHED, gamelogs.EVENT_KEY, lake.path("ck3"),
    )
    query.awaitTermination()
    assert lake.names() == ["ann"]


def test_failed_batch_is_taken_up_again(lake):
    lake.drop("a.json", [log("ann", 1)])
    pipeline.run_chain(lake.ingest)

    def fail(rows):
        raise RuntimeError("lost")

    good, lake.enrich = lake.enrich, fail
    with pytest.raises(Exception, match="lost"):
        lake.merge().awaitTermination()
    lake.enrich = good
    pipeline.run_chain(lake.merge)
    assert lake.names() == ["ann"]


def test_catch_up_adds_what_the_stream_missed(lake):
    lake.drop("a.json", [log("ann", 1)])
    lake.run()
    missed = lake.landing().unionByName(lake.landing().withColumn("user_login", F.lit("late")))
    for _ in range(2):
        pipeline.catch_up(lake.enrich(missed), lake.path("target"), gamelogs.ENRICHED, gamelogs.EVENT_KEY, "2024-01-02")
        assert lake.names() == ["ann", "late"]


def test_interval_trigger_and_purge(lake):
    lake.drop("a.json", [log("ann", 1)])
    query = lake.ingest(every="1 second", purge=True)
    try:
        query.processAllAvailable()
        lake.drop("b.json", [log("bob", 2)])
        query.processAllAvailable()
        lake.drop("c.json", [log("cat", 3)])
        query.processAllAvailable()
        lake.drop("d.json", [log("dan", 4)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert lake.landing().count() == 4
    assert not (lake.folder / "files" / "a.json").exists()


def test_rejected_files_are_kept(lake):
    lake.drop("a.json", [log("ann", 1)])
    (lake.folder / "files" / "bad.json").write_text('{"user_login": "lost')
    pipeline.run_chain(lambda: lake.ingest(purge=True))
    for n in range(4):  # files move to the archive with the batches after theirs
        lake.drop(f"{n}.json", [log("bob", n + 2)])
        pipeline.run_chain(lambda: lake.ingest(purge=True))
    archive = pipeline.archive_of(lake.path("ck1"))
    kept = pipeline.rejects(lake.spark, archive).unionByName(pipeline.rejects(lake.spark, lake.path("files"))).collect()
    assert [(r["file_name"], r["text"]) for r in kept] == [("bad.json", '{"user_login": "lost')]
    assert pipeline.purge_archive(lake.spark, lake.path("ck1")) >= 1
    left = pipeline.rejects(lake.spark, archive).unionByName(pipeline.rejects(lake.spark, lake.path("files"))).count()
    assert left == 1 and lake.landing().count() == 5


def test_a_batch_reads_only_its_days(lake):
    lake.drop("a.json", [log("ann", 1)])
    lake.run()
    found = pipeline.read_target(lake.spark, lake.path("target"), gamelogs.ENRICHED, ["2024-01-01"])
    assert found.count() == 1
    assert pipeline.read_target(lake.spark, lake.path("target"), gamelogs.ENRICHED, ["2024-01-02"]).count() == 0
    assert {r[0].isoformat() for r in lake.target().select("_day").collect()} == {"2024-01-01"}


def test_log_views(spark):
    raw = spark.createDataFrame(
        [('{"agent":"x","user_login":"Kim","datetime_iso8601":"2024-01-01 00:00:00"}',), ('{"ip_address":"1.1.1.1","user_login":"akIMb"}',)],
        "t string",
    ).select(F.try_parse_json("t").alias("raw_log"))
    logs = gamelogs.parse_logs(raw)
    assert gamelogs.with_address(logs).count() == 1 == gamelogs.without_agent(logs).count()
    assert gamelogs.of_player(logs, "%kim%").count() == 2
