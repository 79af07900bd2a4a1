"""Per-user histories, distinct values, set difference, unions.

Lists are built per ``(user, chunk)``: a user's rows are spread over
``ceil(n_rows / chunk_size)`` chunks by an md5 bucket of the row, so no
single array (and no single task) has to hold the history of a user with a
huge share of the rows. Users below ``chunk_size`` rows get one chunk, 0,
holding their whole list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.hashing import hash_unit

CHUNK_SIZE = 10_000


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column (two-phase hash aggregate)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def user_item_plays(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Plays summed per ``(user, item)``; map-side partial sums keep hot keys cheap."""
    return df.groupBy(user_col, item_col).agg(
        F.sum("plays").alias("plays"), F.count(F.lit(1)).alias("n_events")
    )


def chunked_lists(
    df: DataFrame,
    user_col: str,
    item_col: str,
    out: str,
    hash_cols: Sequence[str] | None = None,
    chunk_size: int = CHUNK_SIZE,
) -> DataFrame:
    """``user_col, chunk, out`` where ``out`` is the sorted list of ``item_col``.

    One row per user and chunk: that is the contract, whatever the sizes; join
    on both, or use ``user_lists`` where every user's rows fit one array.
    Chunk of a row = md5 bucket of ``hash_cols`` (default: the item) modulo
    the user's chunk count, so ``hash_cols`` must tell equal rows apart. Row
    counts per user come from a partial aggregate and are joined back. The join leaves all
    rows of a user together, so the rows are dealt out anew on (user, chunk)
    before the lists are built: a hot user's chunks go to many tasks.
    """
    hash_cols = list(hash_cols or [item_col])
    counts = df.groupBy(user_col).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk_size)).cast("bigint").alias("_nchunks")
    )
    with_chunk = df.join(counts, user_col).withColumn(
        "chunk", (hash_unit(hash_cols) % F.col("_nchunks")).cast("int")
    )
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_chunk.repartition(n, user_col, "chunk")
    return dealt.groupBy(user_col, "chunk").agg(F.array_sort(F.collect_list(item_col)).alias(out))


def ground_truth_lists(
    df: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx", chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Items per user with duplicates kept, as doubles (the evaluator's input).

    Equal rows are counted and numbered, so that they spread over chunks too.
    """
    rows = df.select(user_col, F.col(item_col).cast("double").alias("_item"), *[c for c in df.columns if c not in (user_col, item_col)])
    keyed = [c for c in rows.columns if c != user_col]
    told = rows.groupBy(user_col, *keyed).agg(F.count(F.lit(1)).alias("_n"))
    copies = told.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")
    return chunked_lists(copies, user_col, "_item", "true_items", hash_cols=[*keyed, "_copy"], chunk_size=chunk_size)


def user_history(
    df: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx", chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Distinct items per user (a set), distributed instead of collected."""
    pairs = df.select(user_col, item_col).where(F.col(item_col).isNotNull()).distinct()
    return chunked_lists(pairs, user_col, item_col, "items", chunk_size=chunk_size)


def user_lists(df: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """``user, items``: one sorted list of distinct items per user.

    For callers that know their users to be small: a user's items must fit
    one array in one task. ``user_history`` has no such limit.
    """
    return df.where(F.col(item_col).isNotNull()).groupBy(user_col).agg(F.array_sort(F.collect_set(item_col)).alias("items"))


def user_history_all(users: DataFrame, history: DataFrame, user_col: str = "user_idx") -> DataFrame:
    """Every user of ``users`` with its history; an empty list when it has none."""
    return users.select(user_col).join(history, user_col, "left").select(
        user_col,
        F.coalesce("chunk", F.lit(0)).alias("chunk"),
        F.coalesce("items", F.array().cast(history.schema["items"].dataType)).alias("items"),
    )


def unseen_items(
    candidates: DataFrame,
    history: DataFrame,
    user_col: str = "user_idx",
    item_col: str = "item_idx",
) -> DataFrame:
    """Candidate rows whose item the user has not played (``left_anti``).

    Candidates are a bounded per-user list (e.g. top-K recommendations),
    never the full users x items product.
    """
    seen = history.select(user_col, item_col).distinct()
    return candidates.join(seen, [user_col, item_col], "left_anti")


#: Fixed value: bits of one of Spark's bitmaps.
BITMAP_BITS = 32768


def history_bitmaps(df: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """``user, bucket, items``: each user's set of items as bitmaps of ``BITMAP_BITS``
    item indexes; bucket b holds items from (b - 1) * BITMAP_BITS on.

    A user has at most one row a bucket, however many plays; equal plays are
    dropped before the shuffle, so no task gets more than ``BITMAP_BITS`` rows of a
    user and bucket. The bits are dealt by user and bucket as narrow rows and
    become bitmaps, of 4 KB each however few items, only where they end:
    none is shuffled or sorted here. Suits users with many items. Item indexes
    are 0 or more; null items take no part.
    """
    at = F.col(item_col).cast("long") + 1
    rows = df.where(F.col(item_col).isNotNull()).select(user_col, F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("_bit"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a fixed number: few partitions read together would sort more rows in a task
    dealt = rows.distinct().repartition(n, user_col, "bucket")
    return dealt.groupBy(user_col, "bucket").agg(F.bitmap_construct_agg("_bit").alias("items"))


def merged_bitmaps(*parts: DataFrame, user_col: str = "user_idx") -> DataFrame:
    """The bitmaps of several histories as one, so a batch is added without its predecessors' plays."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(user_col, "bucket").agg(F.bitmap_or_agg("items").alias("items"))


def _bit_is_set(bitmap: Column, at: Column) -> Column:
    """Whether bit ``at`` (0 or more; the low bit of a byte first) of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0


def unseen_by_bitmaps(candidates: DataFrame, bitmaps: DataFrame, user_col: str = "user_idx", item_col: str = "item_idx") -> DataFrame:
    """``unseen_items`` against ``history_bitmaps``: one row a user and bucket to join with instead of one a play."""
    at = F.col(item_col).cast("long") + 1
    rows = candidates.withColumns({"bucket": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)})
    # merged, not broadcast: Spark takes a bitmap for far smaller than it is
    joined = rows.join(bitmaps.withColumnRenamed("items", "_items").hint("merge"), [user_col, "bucket"], "left")
    return joined.where(F.col("_items").isNull() | ~_bit_is_set(F.col("_items"), F.col("_bit"))).select(*candidates.columns)


def union_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """History plus new interactions, columns matched by name."""
    return history.unionByName(new, allowMissingColumns=True)
