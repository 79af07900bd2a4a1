"""Event parsing with quarantine, play filter and type normalisation.

One transform serves batch and streaming frames: it only adds columns and
filters, so Structured Streaming runs it per micro-batch unchanged.

Decision per message, in this order (the type is looked at before the
time, as the ingest it replaces did):

1. type present and not the play type -> dropped (not an error)
2. not a JSON object, a field of the wrong type, or a play whose timestamp
   does not parse -> quarantined, with a reason
3. type missing -> dropped
4. else kept
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore import schemas

KEPT, DROPPED = "kept", "dropped"
BAD_JSON, BAD_TIME = "malformed", "bad_timestamp"


def _parsed(raw: DataFrame, value_col: str = "value") -> DataFrame:
    schema = T.StructType(list(schemas.EVENT_JSON.fields) + [T.StructField(schemas.CORRUPT_COLUMN, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN}
    return raw.withColumn("_e", F.from_json(F.col(value_col).cast("string"), schema, opts))


#: Fixed value: a full ISO-8601 date, optionally a time of day, optionally a zone.
ISO_TIME = r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?)(Z|z|[+-]\d{2}:?\d{2})?$"


def iso_time(text: Column) -> Column:
    """ISO-8601 text to wall-clock time (``timestamp_ntz``); null if it is not one.

    A time with a zone is moved to UTC first; without one it is kept as
    written. No session zone is involved. Parts of a date (a bare year) are not times.
    """
    wall = F.regexp_extract(text, ISO_TIME, 1).try_cast("timestamp_ntz")
    zone = F.regexp_replace(F.regexp_extract(text, ISO_TIME, 2), ":", "")
    minutes = F.coalesce(F.substring(zone, 2, 2).try_cast("int"), F.lit(0)) * 60 + F.coalesce(F.substring(zone, 4, 2).try_cast("int"), F.lit(0))
    ahead = F.when(zone.startswith("-"), -minutes).otherwise(minutes)
    return wall - F.make_dt_interval(F.lit(0), F.lit(0), ahead, F.lit(0))


def classify(raw: DataFrame, play_type: str = "play", value_col: str = "value") -> DataFrame:
    """Adds ``_e`` (parsed struct), ``_ts`` and ``status``."""
    p = _parsed(raw, value_col)
    etype = F.col("_e.event_type")
    ts = iso_time(F.col("_e.timestamp"))
    status = (
        F.when(etype.isNotNull() & (etype != play_type), F.lit(DROPPED))
        .when(F.col("_e").isNull() | F.col(f"_e.{schemas.CORRUPT_COLUMN}").isNotNull(), F.lit(BAD_JSON))
        .when((etype == play_type) & ts.isNull(), F.lit(BAD_TIME))
        .when(etype.isNull(), F.lit(DROPPED))
        .otherwise(F.lit(KEPT))
    )
    return p.withColumn("_ts", ts).withColumn("status", status)


def kept_events(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Good plays in canonical form ``user_id, item_id, plays, ts, event_type``.

    ``ts`` is the message's wall-clock time as ``timestamp_ntz``, in UTC if it named a zone.
    """
    return classified.where(F.col("status") == KEPT).select(
        *keep,
        F.col("_e.user_id").alias("user_id"),
        F.col("_e.song_id").alias("item_id"),
        F.col("_e.plays").alias("plays"),
        F.col("_ts").alias("ts"),
        F.col("_e.event_type").alias("event_type"),
    )


def quarantined(classified: DataFrame, keep: tuple[str, ...] = (), value_col: str = "value") -> DataFrame:
    """Bad messages with their raw text and the reason."""
    return classified.where(F.col("status").isin(BAD_JSON, BAD_TIME)).select(
        *keep, F.col(value_col).alias("value"), F.col("status").alias("reason")
    )


def parse_events(raw: DataFrame, play_type: str = "play", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` frames from one parse of ``raw.value``."""
    c = classify(raw, play_type)
    return kept_events(c, keep), quarantined(c, keep)


def filter_plays(df: DataFrame, play_type: str = "play", type_col: str = "event_type") -> DataFrame:
    """Rows of the play type; a missing type never matches."""
    return df.where(F.col(type_col) == play_type)


def cast_interactions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ids to int and plays to double; text that does not fit becomes null.

    ``try_cast`` because ANSI mode (on by default) makes a plain cast of bad
    text fail the job.
    """
    return df.select(
        *keep,
        F.col("user_id").try_cast("int").alias("user_id"),
        F.col("item_id").try_cast("int").alias("item_id"),
        F.col("plays").try_cast("double").alias("plays"),
    )
