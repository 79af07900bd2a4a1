"""File sources, sinks, streaming ingest (file source, availableNow)."""

import os

import pytest

from pyspark.sql import functions as F

from encore import schemas
from encore.operators import events
from encore.sources import files, sinks, tables
from encore.streaming import ingest
from tests.conftest import SF


def test_tsv_csv_readers_with_fixed_schema(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "plays.tsv"), "w") as f:
        f.write("u1\ts1\t3\nu2\ts2\t1\nbad\tline\tx\n")
    df = files.read_raw_interactions(spark, os.path.join(tmp_dir, "plays.tsv"))
    assert df.columns == ["user_id", "item_id", "plays"]
    rows = df.collect()
    assert rows[0]["plays"] == 3 and rows[2]["plays"] is None
    with open(os.path.join(tmp_dir, "meta.csv"), "w") as f:
        f.write('0.5,0.7,AR1,"Name, with comma",rock,1.0,R1,200.5,s1,1999\n')
    m = files.read_item_metadata(spark, os.path.join(tmp_dir, "meta.csv")).first()
    assert m["artist_name"] == "Name, with comma" and m["year"] == 1999 and m["item_id"] == "s1"
    t = files.read_delimited(spark, os.path.join(tmp_dir, "plays.tsv"), schemas.RAW_INTERACTIONS, corrupt_column="_bad")
    assert sum(r["_bad"] is not None for r in t.collect()) == 1
    assert files.rename_positional(df, ["a", "b", "c"]).columns == ["a", "b", "c"]


def test_missing_input_is_typed_empty(spark, tmp_dir):
    df = files.read_parquet_or_empty(spark, os.path.join(tmp_dir, "nope"), schemas.RAW_INTERACTIONS)
    assert df.schema == schemas.RAW_INTERACTIONS and files.is_empty(df)


def test_daily_append_and_latest_partition_pruned(spark, tmp_dir):
    plays = tables.play_events(spark, SF)
    path = os.path.join(tmp_dir, "daily")
    sinks.append_daily(plays, path)
    back = spark.read.parquet(path)
    latest = files.latest_partition(back, "dt")
    newest = plays.agg(F.max(F.to_date("ts"))).first()[0]
    assert latest.count() == plays.where(F.to_date("ts") == newest).count()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "dynamicpruning" in plan.lower() or "scalar-subquery" in plan


def test_kafka_records_round_trip(spark):
    rec = sinks.to_kafka_records(tables.play_events(spark, SF))
    good, bad = events.parse_events(rec.select("value"), play_type="play")
    assert bad.count() == 0 and good.count() == rec.count()


def test_stream_equals_batch_and_restart_is_idempotent(spark, tmp_dir):
    raw = tables.event_messages(tables.event_stream(spark, SF))
    out, quar, ck = (os.path.join(tmp_dir, x) for x in ("plays", "quar", "ck"))
    ingest.run_to_end(ingest.ingest_plays(raw, out, quar, ck, tables.PLAY_EVENT_TYPE, keep=("event_id",)))
    got = spark.read.parquet(out).select("event_id", "user_id", "item_id", "plays", "ts", "event_type")
    batch = events.kept_events(events.classify(tables.raw_event_values(spark, SF), tables.PLAY_EVENT_TYPE), keep=("event_id",))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # same checkpoint again: the source offsets are committed, nothing is re-ingested
    raw2 = tables.event_messages(tables.event_stream(spark, SF))
    ingest.run_to_end(ingest.ingest_plays(raw2, out, quar, ck, tables.PLAY_EVENT_TYPE, keep=("event_id",)))
    assert spark.read.parquet(out).count() == batch.count()
    assert spark.read.parquet(quar).count() == events.quarantined(events.classify(tables.raw_event_values(spark, SF), tables.PLAY_EVENT_TYPE)).count()


def test_daily_plays_stream_with_watermark(spark, tmp_dir):
    plays = tables.play_events(spark, SF)
    stream = spark.readStream.schema(tables.events(spark, SF).schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    stream = stream.where(F.col("event_type") == tables.PLAY_EVENT_TYPE).select(
        "user_id", tables.event_item().alias("item_id"), F.col("value").alias("plays"), "ts"
    )
    q = (
        ingest.daily_plays(stream, watermark="1 day")
        .writeStream.format("memory")
        .queryName("daily_plays_t")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = {r["day"]: r["n_events"] for r in spark.table("daily_plays_t").collect()}
    want = {r["d"]: r["n"] for r in plays.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_dedupe_within_watermark_drops_resent(spark, tmp_dir):
    import json

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    rows = [
        {"event_id": 1, "ts": "2024-01-01 00:00:00", "v": 1},
        {"event_id": 1, "ts": "2024-01-01 00:00:05", "v": 1},  # re-sent
        {"event_id": 2, "ts": "2024-01-01 00:01:00", "v": 2},
    ]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    stream = spark.readStream.schema("event_id long, ts timestamp, v long").json(src)
    q = (
        ingest.dedupe_events(stream, "event_id", "ts", "10 minutes")
        .writeStream.format("memory")
        .queryName("dedup_t")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    assert sorted(r["event_id"] for r in spark.table("dedup_t").collect()) == [1, 2]


def test_monitor_stream_refreshes_on_drift(spark, tmp_dir):
    from encore.plans import monitor

    plays = tables.play_events(spark, SF)
    ref = plays.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("plays", F.col("plays") * 100)
    users = plays.select("user_id").distinct().withColumn("user_idx", F.col("user_id").cast("int"))
    items = plays.select("item_id").distinct().withColumn("item_idx", F.col("item_id").cast("int"))
    history = plays.select(F.col("user_id").cast("int").alias("user_idx"), F.col("item_id").cast("int").alias("item_idx"), "plays")
    runs_t = spark.createDataFrame([(0, 4, 0.05, 10.0, 10, 0.3, 0.1, 1, 1, "m/run=0", 1, "t", 1)], schemas.RUNS)
    sinks.append_runs(runs_t, os.path.join(tmp_dir, "sel", "runs"))
    raw = tables.event_messages(tables.event_stream(spark, SF))
    state = os.path.join(tmp_dir, "state")
    q = monitor.monitor_stream(
        raw, ref, history, os.path.join(tmp_dir, "sel"), users, items,
        os.path.join(tmp_dir, "plays"), os.path.join(tmp_dir, "quar"), os.path.join(tmp_dir, "ck"), state,
        play_type=tables.PLAY_EVENT_TYPE,
    )
    ingest.run_to_end(q)
    saved = os.listdir(os.path.join(state, "models"))
    assert saved and all(s.startswith("batch=") for s in saved)


def test_daily_append_by_ingest_date(spark, tmp_dir):
    import datetime

    plays = tables.play_events(spark, SF)
    path = os.path.join(tmp_dir, "ingest")
    sinks.append_daily(plays, path, by="ingest")
    days = {r["dt"] for r in spark.read.parquet(path).select("dt").distinct().collect()}
    assert days == {datetime.date.today()} or len(days) == 1


def test_daily_plays_upsert_over_several_batches(spark, tmp_dir):
    ev = tables.events(spark, SF).where(F.col("event_type") == tables.PLAY_EVENT_TYPE)
    src = os.path.join(tmp_dir, "src")
    # three files whose days overlap, so later batches update earlier days
    for i in range(3):
        ev.where(F.col("event_id") % 3 == i).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    stream = (
        spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    )
    plays = stream.select("user_id", tables.event_item().alias("item_id"), F.col("value").alias("plays"), "ts")
    out = os.path.join(tmp_dir, "daily")
    q = ingest.write_daily_plays(plays, out, os.path.join(tmp_dir, "ck"), watermark="40 days")
    ingest.run_to_end(q)
    assert len(q.recentProgress) >= 3
    got = {str(r["day"]): (r["n_events"], round(r["plays"], 6)) for r in spark.read.parquet(out).collect()}
    want = {
        r["d"]: (r["n"], round(r["p"], 6))
        for r in ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n"), F.sum("value").alias("p")).collect()
    }
    assert got == want


def test_kafka_options():
    from encore.sources import kafka

    o = kafka.kafka_options("b1:9092", security={"security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}, max_offsets_per_trigger=500)
    assert o["subscribe"] == "daily_interactions" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "true" and o["maxOffsetsPerTrigger"] == "500"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"


def test_run_to_end_raises_at_its_limit(spark, tmp_dir):
    import time

    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ck")
    spark.range(3).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)

    def start(folder):
        w = stream.writeStream.foreachBatch(lambda df, n: time.sleep(4)).option("checkpointLocation", folder)
        return w.trigger(availableNow=True).start()

    slow = start(out)
    with pytest.raises(TimeoutError):
        ingest.run_to_end(slow, timeout_s=1)
    assert not slow.isActive
    again = start(out + "2")
    ingest.run_to_end(again)
    assert not again.isActive
