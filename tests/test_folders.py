"""Batch folders behind a manifest, publishing, streams that run for days."""

import json
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from encore import schemas
from encore.operators import drift, runs
from encore.plans import monitor, train
from encore.sources import folders, sinks, tables
from encore.sources.folders import BatchTable
from encore.streaming import ingest
from tests.conftest import SF


def write_batch(spark, path, batch, rows):
    df = spark.createDataFrame(rows, "dt string, v long").select(F.to_date("dt").alias("dt"), "v").withColumn("batch_id", F.lit(batch))
    ingest._replace(df, path, "dt", "batch_id")


def content(table):
    return sorted((str(r["dt"]), r["v"], r["batch_id"]) for r in table.read().collect())


def test_fifty_batches_become_one_folder_a_day(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    table, want = BatchTable(spark, path), []
    for b in range(50):
        rows = [(f"2024-01-0{1 + b % 2}", 10 * b), ("2024-01-03", 10 * b + 1)]
        write_batch(spark, path, b, rows)
        want += [(d, v, b) for d, v in rows]
        if b == 20:
            first = table.compact(19)
            assert first.upto == 19 and content(table) == sorted(want)
            # a replay of a compacted batch, and one of the newest batch
            write_batch(spark, path, 19, [("2024-01-02", 190), ("2024-01-03", 191)])
            write_batch(spark, path, 20, rows)
            assert content(table) == sorted(want)
    before = table.read()
    assert table.compact(49).folders.keys() == {"2024-01-01", "2024-01-02", "2024-01-03"}
    # readers that started before the swap still find their files
    assert before.count() == len(want) and content(table) == sorted(want)
    assert table.vacuum() == 4 and content(table) == sorted(want)
    assert not table._raw_folders() and len(table.manifest().folders) == 3
    for folder in table.manifest().folders.values():
        assert len([f for f in os.listdir(f"{path}/{folders.COMPACTED}/{folder}") if f.endswith(".parquet")]) == 1
    assert table.compact(49) is None
    write_batch(spark, path, 50, [("2024-01-03", 7)])
    assert content(table) == sorted([*want, ("2024-01-03", 7, 50)])
    assert table.read(upto=49).count() == len(want)


def test_of_two_compactions_at_once_one_wins(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    table = BatchTable(spark, path)
    for b in range(3):
        write_batch(spark, path, b, [("2024-01-01", b)])
    gate, create = threading.Barrier(2), folders.create_if_absent
    monkeypatch.setattr(folders, "create_if_absent", lambda *a: (gate.wait(60), create(*a))[1])
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda _: table.compact(2), range(2)))
    assert sum(r is not None for r in results) == 1 and [r[1] for r in content(table)] == [0, 1, 2]
    assert len([n for n in folders.child_names(spark, f"{path}/{folders.COMPACTED}") if n.startswith("g=")]) == 1


def test_table_without_days_and_missing_table(spark, tmp_dir):
    path = f"{tmp_dir}/h"
    table = BatchTable(spark, path, "batch", None)
    assert table.read() is None and not table.exists() and table.compact(5) is None and table.vacuum() == 0
    for b in range(4):
        spark.createDataFrame([(b, "x")], "v long, w string").write.parquet(f"{path}/batch={b}")
    assert table.compact(2).folders.keys() == {""} and table.vacuum() == 3
    assert sorted(r["v"] for r in table.read().collect()) == [0, 1, 2, 3] and table.read(upto=1).count() == 2


def test_create_if_absent(spark, tmp_dir):
    path = f"{tmp_dir}/a/b"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: folders.create_if_absent(spark, path, f"text é {i}"), range(8)))
    assert made.count(True) == 1
    assert folders.read_text(spark, path) == f"text é {made.index(True)}" and folders.child_names(spark, f"{tmp_dir}/a") == ["b"]


def test_publishers_at_once_get_different_versions(spark, tmp_dir):
    rows = [(i, 4, 0.1, 1.0, 10, m, 0.1, 5, 5, f"m/run={i}", None, "t", 1) for i, m in enumerate((0.9, 0.1))]
    table = spark.createDataFrame(rows, schemas.RUNS)
    sinks.append_runs(table, f"{tmp_dir}/runs")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: train.publish(spark, tmp_dir, runs.best_run(table), f"m/{i}"), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    latest = train.latest_published(spark, tmp_dir).first()
    assert latest["version"] == 4 and latest["path"] == f"m/{got.index(4)}"


def message(event_id, ts, plays=1.0):
    return {"event_id": event_id, "key": "1", "value": json.dumps({"user_id": 1, "song_id": 2, "timestamp": ts, "event_type": "play", "plays": plays})}


def streamed(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def write_lines(folder, n, rows):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{n:03d}.json"
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def test_late_event_corrects_its_day_and_is_listed(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    days = [["2024-01-02", "2024-01-02"], ["2024-01-03", "2024-01-04"], ["2024-01-05"], ["2024-01-06", "2024-01-02"]]
    for n, batch in enumerate(days):
        write_lines(src, n, [{"plays": 1.5, "ts": f"{d} 10:00:00"} for d in batch] + [{"plays": 9.0, "ts": None}])
    stream = streamed(spark, src, "plays double, ts timestamp_ntz")
    q = ingest.write_daily_plays(stream, f"{tmp_dir}/daily", f"{tmp_dir}/ck", watermark="2 days", compact_every=2)
    ingest.run_to_end(q)
    assert len(q.recentProgress) >= 4
    got = {str(r["day"]): (r["n_events"], r["plays"]) for r in spark.read.parquet(f"{tmp_dir}/daily").collect()}
    assert got == {"2024-01-02": (3, 4.5), **{f"2024-01-0{d}": (1, 1.5) for d in (3, 4, 5, 6)}}
    late = spark.read.parquet(f"{tmp_dir}/daily-late").collect()
    assert [(str(r["ts"])[:10], r["batch"]) for r in late] == [("2024-01-02", 3)]


def test_messages_sent_again_in_later_batches_are_dropped_without_state(spark, tmp_dir):
    src, rows = f"{tmp_dir}/src", [message(i, f"2024-01-{1 + i % 5:02d}T10:00:00") for i in range(10)]
    bad = [{"event_id": 100, "key": "1", "value": "{bad"}, {"event_id": 101, "key": "1", "value": json.dumps({"timestamp": "x", "event_type": "play"})}]
    none = [message(None, "2024-01-01T10:00:00")] * 2
    for n in range(10):
        write_lines(src, n, [rows[n], rows[n], rows[n - 1], bad[n % 2], *(none if n == 3 else [])])
    stream = streamed(spark, src, "event_id long, key string, value string")
    out, quar = f"{tmp_dir}/plays", f"{tmp_dir}/quar"
    q = ingest.ingest_plays(stream, out, quar, f"{tmp_dir}/ck", keep=("event_id",), dedupe_on="event_id", compact_every=4)
    ingest.run_to_end(q)
    assert len(q.recentProgress) >= 10 and all(not p["stateOperators"] for p in q.recentProgress)
    got = sorted((r["event_id"] is None, r["event_id"]) for r in ingest.read_plays(spark, out).collect())
    assert got == [(False, i) for i in range(10)] + [(True, None)] * 2
    assert sorted(r["event_id"] for r in ingest.read_plays(spark, quar).collect()) == [100, 101]
    with pytest.raises(ValueError, match="kept"):
        ingest.ingest_plays(stream, out, quar, f"{tmp_dir}/ck2", dedupe_on="event_id")
    with pytest.raises(FileNotFoundError):
        ingest.read_plays(spark, f"{tmp_dir}/nowhere")


def test_merged_counts_and_profiles_equal_those_of_the_whole(spark):
    plays = tables.play_events(spark, SF).withColumn("dt", F.to_date("ts"))
    columns = (["plays"], ["user_id", "item_id"])
    daily = drift.value_counts(plays, *columns, by=["dt"])
    whole, merged = drift.value_counts(plays, *columns), drift.merged_counts(daily)
    assert daily.select("dt").distinct().count() > 5
    assert whole.exceptAll(merged).count() == 0 and merged.exceptAll(whole).count() == 0
    parts = [daily.where("dt < '2024-01-10'"), daily.where("dt >= '2024-01-10'")]
    assert drift.merged_counts(*parts).exceptAll(whole).count() == 0
    profile = drift.merged_profile(drift.numeric_profile(plays, ["plays"], by=["dt"]))
    got = drift.profile_quantiles(profile, (0.1, 0.5, 0.9)).first()
    values = sorted(r["plays"] for r in plays.collect())
    assert (got["n"], got["low"], got["high"]) == (len(values), values[0], values[-1])
    for share, q in zip((0.1, 0.5, 0.9), got["quantiles"]):
        assert abs(sum(v <= q for v in values) / len(values) - share) < 0.02
    odd = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),)], "plays double")
    none = drift.profile_quantiles(drift.numeric_profile(odd, ["plays"])).first()
    assert (none["n"], none["n_null"], none["quantiles"]) == (0, 3, None)


def test_second_batch_does_not_read_the_reference_and_state_is_compacted(spark, tmp_dir):
    """The reference's files are gone after the first batch; the report still comes out."""
    schema = "user_id long, item_id long, plays double"
    rows = [(u, i, 1.0) for u in range(6) for i in range(4)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/ref")
    reference = spark.read.parquet(f"{tmp_dir}/ref")
    users = spark.createDataFrame([(u, u) for u in range(6)], "user_id long, user_idx int")
    items = spark.createDataFrame([(i, i) for i in range(4)], "item_id long, item_idx int")
    history = spark.createDataFrame(rows, "user_idx int, item_idx int, plays double")
    sinks.append_runs(spark.createDataFrame([(0, 2, 0.1, 1.0, 10, 0.5, 0.1, 5, 5, "m/run=0", 1, "t", 1)], schemas.RUNS), f"{tmp_dir}/sel/runs")
    state = monitor.Monitor(spark, f"{tmp_dir}/state", reference, history, users, items, compact_every=2)
    new = spark.createDataFrame(rows, schema)
    full = drift.drift_report(reference, new, ["plays"], ["user_id", "item_id"]).orderBy("column").collect()
    assert state.on_batch(new, 0, f"{tmp_dir}/sel").report.orderBy("column").collect() == full
    folders.delete(spark, f"{tmp_dir}/ref")
    for n in range(1, 5):
        decision = state.on_batch(new.unionByName(spark.createDataFrame([(100 + n, 0, 1.0)], schema)), n, f"{tmp_dir}/sel")
        assert decision.report.count() == 3 and decision.model is None
    assert state.tables["history"].manifest().upto == 3 and state.tables["users"].read().count() == 4
    assert state.tables["history"].read().count() == 5 * 24 + 4
    for table in state.tables.values():
        table.vacuum()
    again = monitor.Monitor(spark, f"{tmp_dir}/state", reference, history, users, items)
    assert again._known("users", users, 4).count() == 10
