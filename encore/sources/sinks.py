"""Sinks: Parquet overwrite, daily partitions, event records, run log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import dropping_shuffles
from encore.sources import folders

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the dataset at ``path`` whole."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        w.parquet(path)


def with_event_date(df: DataFrame, ts_col: str = "ts", out: str = "dt", by: str = "event") -> DataFrame:
    """Add the date partition column: the event's date, or with
    ``by="ingest"`` the date the batch is written (``current_date``)."""
    if by == "ingest":
        return df.withColumn(out, F.current_date())
    return df.withColumn(out, F.to_date(F.col(ts_col)))


def append_daily(df: DataFrame, path: str, ts_col: str = "ts", by: str = "event") -> None:
    """Append into ``path/dt=YYYY-MM-DD`` folders.

    By default the folder is the event's own date: a late event stays with
    the other events of its day and readers prune folders by event time.
    ``by="ingest"`` files every row under the day it was written instead.
    """
    with_event_date(df, ts_col, by=by).write.mode("append").partitionBy("dt").parquet(path)


def daily_partition_counts(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Rows per event date, i.e. what ``append_daily`` writes per folder."""
    return (
        with_event_date(df, ts_col)
        .groupBy("dt")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
        .select(F.date_format("dt", "yyyy-MM-dd").alias("dt"), "n_rows")
    )


def to_kafka_records(
    plays: DataFrame,
    event_type: str = "play",
    user_col: str = "user_id",
    item_col: str = "item_id",
) -> DataFrame:
    """Play rows as event messages: ``key`` = user id text, ``value`` = JSON.

    The JSON carries ``user_id, song_id, timestamp, event_type, plays`` with
    the timestamp in ISO-8601 with microseconds.
    """
    value = F.to_json(
        F.struct(
            F.col(user_col).alias("user_id"),
            F.col(item_col).alias("song_id"),
            F.date_format("ts", ISO_MICROS).alias("timestamp"),
            F.lit(event_type).alias("event_type"),
            F.col("plays").alias("plays"),
        )
    )
    return plays.select(F.col(user_col).cast("string").alias("key"), value.alias("value"))


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run records (params + metrics) to the runs table.

    The files are written aside and then moved in one by one (their names
    are unique), so appends at the same time do not share a folder of unfinished files.
    """
    spark, path = runs.sparkSession, path.rstrip("/")
    aside = f"{path}/.append-{uuid.uuid4().hex}"
    runs.write.parquet(aside)
    for name in folders.child_names(spark, aside):
        if not name.startswith(("_", ".")):
            folders.move(spark, f"{aside}/{name}", f"{path}/{name}")
    folders.delete(spark, aside)
