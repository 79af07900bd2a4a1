"""Views over the given Parquet tables in the canonical interaction schema.

``interactions``: one row per ``lineitem`` line, joined to its order:
``o_custkey`` is the user, ``l_partkey`` the item, ``l_quantity`` the play
count and ``l_shipdate`` the time.

``play_events``: ``events`` rows of the play type (``view`` stands in for
``play``) with the item taken from the ``props`` JSON (``{"k": n}``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLAY_EVENT_TYPE = "view"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, item_id, plays, ts`` from ``lineitem`` joined with ``orders``.

    Only four columns are read from ``lineitem`` and two from ``orders``
    (column pruning reaches the Parquet scan). The join is a shuffled
    sort-merge join at scale; AQE turns it into a broadcast only when the
    runtime size of ``orders`` is under the broadcast threshold.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_ok"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("double").alias("plays"),
        F.col("l_shipdate").alias("ts"),
    )
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_ok"), F.col("o_custkey").alias("user_id")
    )
    return li.join(od, "_ok").select("user_id", "item_id", "plays", "ts")


def bucket_order_tables(spark: SparkSession, sf_dir: str, buckets: int, prefix: str = "encore_") -> None:
    """Write the join columns of ``lineitem`` and ``orders`` as tables bucketed
    and sorted on the order key, with the same bucket count.

    A one-off layout step for repeated runs: afterwards
    ``interactions_bucketed`` joins the two without shuffling either side
    (the largest join of the pipeline becomes a co-located merge join).
    """
    (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        .write.mode("overwrite")
        .bucketBy(buckets, "l_orderkey")
        .sortBy("l_orderkey")
        .saveAsTable(f"{prefix}lineitem")
    )
    (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .write.mode("overwrite")
        .bucketBy(buckets, "o_orderkey")
        .sortBy("o_orderkey")
        .saveAsTable(f"{prefix}orders")
    )


def interactions_bucketed(spark: SparkSession, prefix: str = "encore_") -> DataFrame:
    """``interactions`` over the tables written by ``bucket_order_tables``."""
    li = spark.table(f"{prefix}lineitem")
    od = spark.table(f"{prefix}orders")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"]).select(
        od["o_custkey"].alias("user_id"),
        li["l_partkey"].alias("item_id"),
        li["l_quantity"].cast("double").alias("plays"),
        li["l_shipdate"].alias("ts"),
    )


def item_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item to track mapping: distinct ``(l_partkey, l_suppkey)`` pairs."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("track_id"))
        .distinct()
    )


def item_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata: the ``part`` table keyed by ``item_id``."""
    return table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "item_id")


def event_item(props: str = "props") -> F.Column:
    """Item id stored in the event ``props`` JSON under ``k``."""
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def play_events(spark: SparkSession, sf_dir: str, play_type: str = PLAY_EVENT_TYPE) -> DataFrame:
    """Play events in canonical form ``user_id, item_id, plays, ts``.

    The event-type predicate is pushed to the Parquet scan.
    """
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == play_type)
        .select("user_id", event_item().alias("item_id"), F.col("value").alias("plays"), "ts")
    )


def event_messages(ev: DataFrame) -> DataFrame:
    """Event rows as the JSON messages a producer publishes: ``event_id, key, value``.

    Works on batch and streaming frames. The ``event_type`` is carried as
    is. To exercise the quarantine path on the whole table, every row is
    kept and a fixed share is damaged by rule: ``event_id % 10 = 0`` gets a
    truncated JSON text, ``event_id % 10 = 1`` an unparseable timestamp.
    """
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = F.when(F.col("event_id") % 10 == 1, F.lit("not-a-time")).otherwise(stamp)
    body = F.to_json(
        F.struct(
            F.col("user_id"),
            event_item().alias("song_id"),
            stamp.alias("timestamp"),
            F.col("event_type"),
            F.col("value").alias("plays"),
        )
    )
    value = F.when(F.col("event_id") % 10 == 0, F.expr("substring(_body, 1, length(_body) - 1)")).otherwise(
        F.col("_body")
    )
    return ev.select("event_id", F.col("user_id").cast("string").alias("key"), body.alias("_body")).select(
        "event_id", "key", value.alias("value")
    )


def raw_event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_messages`` of the ``events`` table."""
    return event_messages(events(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` read as a file stream (new Parquet files become new rows)."""
    schema = events(spark, sf_dir).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)
