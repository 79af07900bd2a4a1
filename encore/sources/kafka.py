"""Kafka source and sink options.

The Kafka connector is not on every classpath (it is not on the test
machine); these functions only build the reader/writer, so the transform
that follows (``encore.operators.events.parse_events``) is tested on a file
source with the same ``key``/``value`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TOPIC = "daily_interactions"


def kafka_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    security: dict[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. Client settings (SASL etc.) go through ``kafka.*`` keys."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        # A gap in offsets (retention ran out) is reported, not skipped silently.
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for k, v in (security or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming frame ``key, value`` (text), plus topic coordinates."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    )


def read_kafka_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Batch read of a topic range (same columns as the stream)."""
    return (
        spark.read.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    )


def write_kafka(records: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Publish ``key, value`` records (see ``sinks.to_kafka_records``)."""
    (
        records.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
