"""Structured Streaming ingest: messages -> parsed plays -> daily Parquet.

The stream is the same ``key, value`` frame from Kafka in production or
from files in tests; ``encore.operators.events`` does the parsing. Good
rows go to a ``dt``-partitioned Parquet table by event date, bad ones to a
quarantine table; both are written from one ``foreachBatch`` so a message
is parsed once. The checkpoint holds source offsets, so each message is
consumed once across restarts (nothing has to be deleted after use); a
replayed micro-batch overwrites its own ``batch_id`` folders, so output is
exactly-once even though ``foreachBatch`` is at-least-once. No query here keeps
state that grows with the stream: messages sent again are found among the stored rows of
their day, daily sums are kept as one partial row a day and batch, and
``folders.BatchTable`` compacts what has many batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from encore.operators import events
from encore.sources.folders import BatchTable, child_names

Trigger = dict


def parse_stream(raw: DataFrame, play_type: str = "play", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Streaming ``(good, bad)``; ``ts`` is ``timestamp_ntz`` (cast it to a
    zone-aware timestamp before a watermark, as ``daily_plays`` does)."""
    return events.parse_events(raw, play_type, keep)


def daily_plays(plays: DataFrame, watermark: str = "1 day", ts_col: str = "ts") -> DataFrame:
    """Plays and events per event day, with late data bounded by ``watermark``.

    Watermarks need a zone-aware timestamp, and ``ts`` is a wall-clock
    ``timestamp_ntz``: it is mapped to the instant whose UTC wall clock is
    the same, windowed by UTC days and rendered back in UTC, so a day is the
    events' own calendar day whatever the session time zone.
    """
    tz = plays.sparkSession.conf.get("spark.sql.session.timeZone")
    t = F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), tz)
    return (
        plays.withColumn("_t", t)
        .withWatermark("_t", watermark)
        .groupBy(F.window("_t", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_events"), F.sum("plays").alias("plays"))
        .select(F.date_format(F.to_utc_timestamp(F.col("w.start"), tz), "yyyy-MM-dd").alias("day"), "n_events", "plays")
    )


def write_daily_plays(
    plays: DataFrame,
    out_path: str,
    checkpoint: str,
    watermark: str = "1 day",
    trigger: Trigger | None = None,
    ts_col: str = "ts",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Maintain plays and events per event day as a Parquet table partitioned by ``day``.

    Each micro-batch writes its sums, one row a day, to ``<out_path>-parts``
    (replaced when replayed), and the days it touched are added up anew from
    there, so a late event corrects its day however late it is. Rows more than
    ``watermark`` behind the newest event of the earlier batches are also
    listed in ``<out_path>-late`` (all columns, by batch). Rows without a
    time take no part. ``compact_every``: compact the parts after that many batches.
    """
    parts = BatchTable(plays.sparkSession, f"{out_path.rstrip('/')}-parts", "batch", "day")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.where(F.col(ts_col).isNotNull()).persist()
        try:
            _late_rows(batch, parts, batch_id, watermark, ts_col).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}-late/batch={batch_id}")
            sums = batch.groupBy(F.date_format(ts_col, "yyyy-MM-dd").alias("day")).agg(
                F.count(F.lit(1)).cast("bigint").alias("n_events"), F.sum("plays").alias("plays"), F.max(ts_col).alias("last")
            )
            _replace(sums.withColumn("batch", F.lit(batch_id)), parts.path, "day", "batch")
        finally:
            batch.unpersist()
        stored = parts.read(upto=batch_id)
        if stored is not None:
            # a row a day: what this batch wrote names the days it touched
            touched = stored.where(F.col("batch") == batch_id).select("day").distinct()
            again = stored.join(F.broadcast(touched), "day", "left_semi").groupBy("day")
            days = again.agg(F.sum("n_events").alias("n_events"), F.sum("plays").alias("plays"))
            _replace(days.select("n_events", "plays", F.col("day").cast("string").alias("day")), out_path, "day")
        if compact_every and batch_id and batch_id % compact_every == 0:
            # this batch may still be replayed: only those before it
            parts.compact(batch_id - 1)

    q = plays.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"availableNow": True})).start()


def _replace(rows: DataFrame, path: str, *folders: str) -> None:
    """Write ``rows`` over the folders they belong to, leaving the others."""
    writer = rows.hint("rebalance", *folders[:1]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def _late_rows(batch: DataFrame, parts: BatchTable, batch_id: int, watermark: str, ts_col: str) -> DataFrame:
    """The rows of ``batch`` behind the watermark that the batches before it had reached."""
    before = parts.read(upto=batch_id - 1)
    if before is None:
        return batch.limit(0)
    mark = before.agg(F.max("last")).scalar() - F.expr(f"INTERVAL {watermark}")
    return batch.where(F.col(ts_col) < mark)


def dedupe_events(stream: DataFrame, id_col: str, ts_col: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """Drop re-sent messages (same id) that arrive within the watermark."""
    return stream.withColumn("_t", F.col(ts_col).cast("timestamp")).withWatermark("_t", watermark).dropDuplicatesWithinWatermark([id_col]).drop("_t")


def first_sent(rows: DataFrame, id_col: str) -> DataFrame:
    """One row of each id; rows without an id all stay."""
    return rows.where(F.col(id_col).isNull()).unionByName(rows.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]))


def not_stored(rows: DataFrame, table: BatchTable, batch_id: int, id_col: str) -> DataFrame:
    """The rows whose id no earlier batch of ``table`` stored.

    With days, only the stored ids of the days in ``rows`` are read: a
    message sent again has the time it had first. Rows without an id all stay.
    """
    stored = table.read(upto=batch_id - 1)
    if stored is None:
        return rows
    keys = [id_col]
    if table.day is not None:
        keys.append(table.day)
        # as many rows as a batch has days; prunes the folders that are read
        stored = stored.join(F.broadcast(rows.select(table.day).distinct()), table.day, "left_semi")
    known = stored.select(*keys).where(F.col(id_col).isNotNull()).distinct()
    return rows.join(known, keys, "left_anti")


def ingest_plays(
    raw: DataFrame,
    out_path: str,
    quarantine_path: str,
    checkpoint: str,
    play_type: str = "play",
    keep: tuple[str, ...] = (),
    trigger: Trigger | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    dedupe_on: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start the ingest query.

    ``dedupe_on`` names an id column (one of ``keep``) by which messages sent
    again are dropped, within a batch and against what earlier batches
    stored; nothing is remembered besides the stored rows.

    ``trigger`` defaults to ``availableNow`` (drain what is there, then
    stop); pass ``{"processingTime": "30 seconds"}`` to poll. ``on_batch``
    gets the good rows of each micro-batch after they are written (e.g.
    drift check + refresh). ``compact_every``: after that many batches the
    earlier ones are compacted; read the tables with ``read_plays`` then.
    """
    if dedupe_on and dedupe_on not in keep:
        raise ValueError(f"{dedupe_on} must be kept to find messages sent again")
    plays = BatchTable(raw.sparkSession, out_path.rstrip("/"))
    rejected = BatchTable(raw.sparkSession, quarantine_path.rstrip("/"), day=None)

    def write(batch: DataFrame, batch_id: int) -> None:
        c = events.classify(first_sent(batch, dedupe_on) if dedupe_on else batch, play_type).persist()
        held = [c]
        try:
            tag = F.lit(batch_id).cast("bigint")
            good = events.kept_events(c, keep).withColumn("dt", F.to_date("ts"))
            bad = events.quarantined(c, keep)
            if dedupe_on:
                good = not_stored(good, plays, batch_id, dedupe_on).persist()
                bad = not_stored(bad, rejected, batch_id, dedupe_on)
                held.append(good)
            good, bad = good.withColumn("batch_id", tag), bad.withColumn("batch_id", tag)
            # (dt, batch_id) folders replaced whole: a replayed batch rewrites
            # its own folders instead of appending a second copy
            _replace(good, out_path, "dt", "batch_id")
            _replace(bad, quarantine_path, "batch_id")
            if on_batch is not None:
                # the batch's own good rows, still cached: no listing or
                # re-read of the growing output table
                on_batch(good, batch_id)
        finally:
            for df in held:
                df.unpersist()
        if compact_every and batch_id and batch_id % compact_every == 0:
            # this batch may still be replayed: only those before it
            plays.compact(batch_id - 1)
            rejected.compact(batch_id - 1)

    w = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def read_plays(spark: SparkSession, path: str) -> DataFrame:
    """The stored plays (or, with folders of batches alone, the quarantine), compacted or not."""
    names = child_names(spark, path)
    table = BatchTable(spark, path.rstrip("/"), day=None if any(n.startswith("batch_id=") for n in names) else "dt")
    rows = table.read()
    if rows is None:
        raise FileNotFoundError(path)
    return rows


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query; surface its failure.

    Waits as long as the query takes. With ``timeout_s`` a query still active by then is
    stopped and reported, so a half-written output is never taken as whole.
    """
    ended = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if timeout_s is not None and not ended:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout_s} s; stopped")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
