"""Global order statistics without a single-partition window.

``row_number() over (order by k)`` and ``sum(x) over (order by k)`` with no
``partition by`` move every row into one task (``Exchange SinglePartition``).
Here the keys are range-partitioned instead, each partition is sorted and
written as a table (so partition ids stay fixed between the two passes
below). One pass computes per-partition totals (one row per partition, so
the offsets table is bounded by the partition count and safe to
broadcast); the other adds the offsets to partition-local positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.session import dropping_shuffles, ensure_checkpoint_dir, scratch_path


def default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged(
    df: DataFrame, key: str, n_parts: int | None = None, name: str = "ranged", order: Sequence[str] | None = None
) -> DataFrame:
    """Range-partition on ``key``, sort each partition, write it as a table.

    Adds ``_pid`` (range partition, in key order) and ``_pos`` (0-based
    position inside it, from ``monotonically_increasing_id``: partition id
    in the upper bits, row position in the lower 33). Range boundaries
    come from sampling, so a recompute could move rows between partitions;
    the table, written in the shared checkpoint folder, fixes them once and
    cuts the lineage (one sampling job + one write job).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or default_partitions(df)
    pid = F.spark_partition_id()
    cols = list(order or [key])
    out = (
        df.repartitionByRange(n, *[F.col(c) for c in cols])
        .sortWithinPartitions(*cols)
        .withColumn("_pid", pid)
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    path = scratch_path(spark, name)
    with dropping_shuffles(spark):
        out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def numbered(df: DataFrame, order: Sequence[str], out: str, n_parts: int | None = None) -> DataFrame:
    """``df`` with the 0-based place of each row in the order of the columns ``order``.

    The rows are written range-partitioned and sorted (``ranged``), so rows
    equal in ``order`` keep the places they were given.
    """
    pos = ranged(df, order[0], n_parts, f"numbered-{out}", order)
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per range partition: bounded by n, safe to broadcast
    return pos.join(F.broadcast(offsets), "_pid").select(*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_pos")).alias(out))


def contiguous_index(df: DataFrame, key: str, out: str, n_parts: int | None = None) -> DataFrame:
    """``key, out`` where ``out`` = 0-based rank of ``key`` among its distinct values.

    Same values as ``row_number() over (order by key) - 1`` over the
    distinct non-null keys; null keys get no index. The distinct keys are
    written range-partitioned and sorted (``ranged``); the index is the
    partition's offset (count of keys in earlier partitions) plus the
    position inside it, so no shuffle follows the write.
    """
    pos = ranged(df.select(key).where(F.col(key).isNotNull()).distinct(), key, n_parts, f"index-{out}")
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per range partition: bounded by n, safe to broadcast
    return pos.join(F.broadcast(offsets), "_pid").select(key, (F.col("_off") + F.col("_pos")).cast("int").alias(out))


def contiguous_indexes(df: DataFrame, keys: Sequence[tuple[str, str]], n_parts: int | None = None) -> list[DataFrame]:
    """Several ``contiguous_index`` results from one pass over ``df``.

    ``keys`` are ``(key column, index column)`` pairs of one data type. The
    distinct values of all of them are written as one range-partitioned
    table keyed by ``(kind, value)``; the offset of a value is the count of
    values of its kind in earlier partitions, and its position is counted
    from the first row of its kind in its partition. One scan of ``df``
    instead of one per key.
    """
    types = {df.schema[k].dataType for k, _ in keys}
    if len(types) != 1:
        return [contiguous_index(df, k, out, n_parts) for k, out in keys]
    tagged = df.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).alias("value")) for i, (k, _) in enumerate(keys)])).alias("_e")
    ).select("_e.kind", "_e.value")
    distinct = tagged.where(F.col("value").isNotNull()).distinct()
    pos = ranged(distinct, "kind", n_parts, "index-" + "-".join(out for _, out in keys), order=("kind", "value"))
    per = pos.groupBy("_pid", "kind").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy("kind").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (range partition, kind): bounded, safe to broadcast
    offsets = per.select("_pid", "kind", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    idx = pos.join(F.broadcast(offsets), ["_pid", "kind"]).select(
        "kind", "value", (F.col("_off") + F.col("_pos") - F.col("_first")).cast("int").alias("_idx")
    )
    return [idx.where(F.col("kind") == i).select(F.col("value").alias(k), F.col("_idx").alias(out)) for i, (k, out) in enumerate(keys)]


def running_totals(
    df: DataFrame,
    key: str,
    sum_cols: Sequence[str],
    n_parts: int | None = None,
    group: str | None = None,
) -> DataFrame:
    """Inclusive running sums in ascending ``key`` order, plus the next key.

    ``df`` must hold one row per distinct non-null ``key`` (per ``group``
    when given: then every group has its own running sums). Returns
    ``group``, ``key``, the ``sum_cols``, ``cum_<c>`` and group total
    ``tot_<c>`` for each, and ``next_key`` (the next larger key of the
    group, null for the last). Used for empirical CDFs over value counts.
    The per-(partition, group) summary has at most n x groups rows, so it is
    broadcast. Empty input gives no rows.
    """
    g = [group] if group else []
    parts = ranged(df.select(*g, key, *sum_cols), key, n_parts, "cdf", order=[*g, key])
    w = Window.partitionBy("_pid", *g).orderBy(key)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.select(
        "_pid",
        *g,
        key,
        *sum_cols,
        *[F.sum(c).over(upto).alias(f"_lc_{c}") for c in sum_cols],
        F.lead(key).over(w).alias("_lnext"),
    )
    summary = parts.groupBy("_pid", *g).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], F.min(key).alias("_first"))
    ordered = Window.partitionBy(*g).orderBy("_pid")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    # one row per (range partition, group), so these windows see few rows
    offsets = summary.select(
        "_pid",
        *g,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(whole).alias(f"tot_{c}") for c in sum_cols],
        F.lead("_first").over(ordered).alias("_nfirst"),
    )
    return local.join(F.broadcast(offsets), ["_pid", *g]).select(
        *g,
        key,
        *sum_cols,
        *[(F.col(f"_o_{c}") + F.col(f"_lc_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[f"tot_{c}" for c in sum_cols],
        F.coalesce("_lnext", "_nfirst").alias("next_key"),
    )
