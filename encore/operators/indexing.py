"""Contiguous integer ids and the joins that apply them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.prefix import contiguous_index, contiguous_indexes


def index_users(interactions: DataFrame, n_parts: int | None = None) -> DataFrame:
    """``user_id, user_idx``: 0-based, gap-free, in ``user_id`` order."""
    return contiguous_index(interactions, "user_id", "user_idx", n_parts)


def index_items(interactions: DataFrame, n_parts: int | None = None) -> DataFrame:
    """``item_id, item_idx``: 0-based, gap-free, in ``item_id`` order."""
    return contiguous_index(interactions, "item_id", "item_idx", n_parts)


def index_pair(interactions: DataFrame, n_parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(users, items)`` dictionaries from one pass over ``interactions``."""
    users, items = contiguous_indexes(interactions, [("user_id", "user_idx"), ("item_id", "item_idx")], n_parts)
    return users, items


# Dictionaries estimated under this size are broadcast to every executor.
BROADCAST_LIMIT_BYTES = 128 << 20


# Bytes per value used for size estimates (Spark's default
# sizes; types not listed are taken as 64, text is measured).
_WIDTH = {"long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "integer": 4, "float": 4, "date": 4,
          "short": 2, "byte": 1, "boolean": 1, "string": 0, "binary": 0}


def estimated_bytes(df: DataFrame) -> int:
    """Rows x (sum of the columns' value sizes + row overhead) + the bytes of text: one job."""
    measured = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    sizes = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in measured]
    rows, *texts = df.agg(F.count(F.lit(1)), *sizes).first()
    return rows * (sum(_WIDTH.get(f.dataType.typeName(), 64) for f in df.schema.fields) + 16) + sum(texts)


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is under ``limit_bytes``, else ``df``.

    Rows are counted and texts measured, so the broadcast has a proven
    bound; above it the join stays a shuffled join.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def index_interactions(
    interactions: DataFrame,
    users: DataFrame,
    items: DataFrame,
    keep: tuple[str, ...] = ("plays",),
    broadcast_limit: int | None = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Replace raw ids by indexes: ``user_idx, item_idx`` + ``keep`` columns.

    Inner joins, so rows with a null or unknown id are dropped. A
    dictionary whose counted size is under ``broadcast_limit`` is broadcast,
    so the interactions are not shuffled for that join at all (AQE would
    only switch to a broadcast after both sides were shuffled). Larger
    dictionaries stay sort-merge joins, where AQE splits skewed partitions
    of the interaction side (a user holding a large share of rows).
    ``broadcast_limit=None`` leaves every decision to AQE.
    """
    if broadcast_limit is not None:
        users = broadcast_if_small(users, broadcast_limit)
        items = broadcast_if_small(items, broadcast_limit)
    return (
        interactions.join(users, "user_id")
        .join(items, "item_id")
        .select("user_idx", "item_idx", *keep)
    )


def attach_item_index(df: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Left join: every row of ``df`` kept, ``item_idx`` null for unplayed items."""
    return df.join(items, key, "left")


def cast_indexed(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Index columns as int and plays as double (what ALS expects)."""
    return df.select(
        F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("plays").cast("double"), *keep
    )


def extend_index(known: DataFrame, new: DataFrame, key: str, index: str, n_parts: int | None = None) -> DataFrame:
    """``key, index`` of the ids of ``new`` that ``known`` lacks, numbered on
    from its highest index in id order; known ids keep theirs."""
    ids = new.select(F.col(key).cast(known.schema[key].dataType).alias(key)).join(known.select(key), key, "left_anti")
    free = F.coalesce(known.select(F.max(index)).scalar(), F.lit(-1)) + 1
    return contiguous_index(ids, key, index, n_parts).select(key, (F.col(index) + free).cast("int").alias(index))
