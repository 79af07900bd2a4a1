"""Event parsing: hand-made messages and their expected outcome."""

import datetime

from pyspark.sql import functions as F

from encore.operators import events

ROWS = [
    ('{"user_id":1,"song_id":7,"timestamp":"2025-02-05T16:49:00.504123","event_type":"play","plays":3}', "kept"),
    ("not json", "malformed"),
    ('{"user_id":1,"event_type":"skip"}', "dropped"),
    ('{"user_id":1}', "dropped"),
    ('{"user_id":2,"song_id":7,"timestamp":"garbage","event_type":"play","plays":3}', "bad_timestamp"),
    ('{"user_id":2,"song_id":7,"timestamp":"2025-01-01T00:00:00","event_type":"play","plays":"x"}', "malformed"),
    ("[1]", "malformed"),
    ("null", "malformed"),
    ("", "malformed"),
    ('{"user_id":"u9","song_id":"s1","timestamp":"2025-01-01T00:00:00","event_type":"play","plays":2.5}', "kept"),
]


def raw(spark):
    return spark.createDataFrame([(i, v) for i, (v, _) in enumerate(ROWS)], "id long, value string")


def test_classify_hand_made_rows(spark):
    got = {r["id"]: r["status"] for r in events.classify(raw(spark)).select("id", "status").collect()}
    assert got == {i: want for i, (_, want) in enumerate(ROWS)}


def test_kept_values_keep_microseconds_and_numeric_ids(spark):
    good, bad = events.parse_events(raw(spark), keep=("id",))
    rows = {r["id"]: r for r in good.collect()}
    assert set(rows) == {0, 9}
    assert rows[0]["user_id"] == "1" and rows[0]["item_id"] == "7"  # JSON numbers read as text
    assert rows[0]["ts"] == datetime.datetime(2025, 2, 5, 16, 49, 0, 504123)
    assert rows[0]["plays"] == 3.0 and rows[9]["plays"] == 2.5
    assert bad.count() == 6
    assert set(bad.select("reason").distinct().toPandas()["reason"]) == {"malformed", "bad_timestamp"}


def test_cast_interactions_nulls_bad_text(spark):
    df = spark.createDataFrame([("1", "7", 3.0), ("u9", "s1", 2.5), ("2", "8", None)], "user_id string, item_id string, plays double")
    got = events.cast_interactions(df).collect()
    assert [tuple(r) for r in got] == [(1, 7, 3.0), (None, None, 2.5), (2, 8, None)]


def test_filter_plays_drops_missing_type(spark):
    df = spark.createDataFrame([("play",), ("skip",), (None,)], "event_type string")
    assert events.filter_plays(df).count() == 1


def test_parse_on_driver_table_matches_rule(spark):
    from tests.conftest import SF
    from encore.sources import tables

    c = events.classify(tables.raw_event_values(spark, SF), tables.PLAY_EVENT_TYPE)
    counts = {r["status"]: r["count"] for r in c.groupBy("status").count().collect()}
    ev = tables.events(spark, SF)
    n_bad_json = ev.where(F.col("event_id") % 10 == 0).count()
    assert counts["malformed"] == n_bad_json
    assert sum(counts.values()) == ev.count()  # every message gets exactly one status


def test_iso_times_with_zones_and_parts(spark):
    cases = {
        "2025-02-05T23:30:00-05:00": "2025-02-06 04:30:00",
        "2025-02-05T23:30:00+0200": "2025-02-05 21:30:00",
        "2025-02-05T23:30:00.25Z": "2025-02-05 23:30:00.25",
        "2025-02-05T23:30": "2025-02-05 23:30:00",
        "2025-02-05": "2025-02-05 00:00:00",
        "2025": None, "2025-02": None, "2025-13-01": None, "12:30": None, "": None, "x2025-02-05": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select("t", events.iso_time(F.col("t")).cast("string").alias("w")).collect()
    assert {r["t"]: r["w"] for r in got} == cases
