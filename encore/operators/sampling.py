"""Splits, samples and time windows.

Hash-based splits and samples depend only on the row key, so they are the
same on every run, partitioning and retry; ``randomSplit``/``sample`` are
kept as ``random_split`` and ``bernoulli_sample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.hashing import hash_bucket

SPLIT_BUCKETS = 100
SAMPLE_BUCKETS = 10_000


def split_bounds(weights: Sequence[float], buckets: int = SPLIT_BUCKETS) -> list[tuple[int, int]]:
    """Bucket ranges ``[lo, hi)`` for normalised ``weights``."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = round(acc / total * buckets)
        acc += w
        bounds.append((lo, round(acc / total * buckets)))
    return bounds


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.6, 0.2, 0.2),
    buckets: int = SPLIT_BUCKETS,
    method: str = "md5",
) -> list[DataFrame]:
    """Disjoint, complete split by ``md5(key) % buckets``.

    Rows sharing a key land in the same part (no leakage between parts);
    with keys ``user_id, item_id`` all plays of one pair stay together, so
    shares deviate slightly from ``weights`` when pairs repeat.
    """
    b = hash_bucket(keys, buckets, method)
    return [df.where((b >= lo) & (b < hi)) for lo, hi in split_bounds(weights, buckets)]


def split_label(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float],
    names: Sequence[str],
    out: str = "split",
    buckets: int = SPLIT_BUCKETS,
    method: str = "md5",
    seed: int = 42,
) -> DataFrame:
    """The same split as ``hash_split``, as a label column (one pass);
    ``method="random"`` draws rows by ``seed`` instead of by key."""
    if method == "random":
        # one draw a row, by its place; write the result before using it twice
        df, b = df.withColumn("_draw", F.floor(F.rand(seed) * buckets).cast("int")), F.col("_draw")
    else:
        b = hash_bucket(keys, buckets, method)
    label = None
    for (lo, hi), name in zip(split_bounds(weights, buckets), names):
        cond = (b >= lo) & (b < hi)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return df.withColumn(out, label).drop("_draw")


def random_split(df: DataFrame, weights: Sequence[float] = (0.6, 0.2, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit``; the row set depends on partitioning and order."""
    return df.randomSplit(list(weights), seed=seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """``df.sample(fraction, seed)``; the row set depends on partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame, fraction: float, keys: Sequence[str], buckets: int = SAMPLE_BUCKETS, method: str = "md5"
) -> DataFrame:
    """Rows whose key falls in the first ``fraction`` of hash buckets."""
    return df.where(hash_bucket(keys, buckets, method) < F.lit(int(round(fraction * buckets))))


def recent_window(
    df: DataFrame,
    days: int = 30,
    as_of: Column | str | None = None,
    ts_col: str = "ts",
) -> DataFrame:
    """Rows with ``ts >= as_of - days``.

    ``as_of`` defaults to the newest ``ts`` of the table (a scalar subquery,
    run once); ``"now"`` is the query start time; another string is read
    as a timestamp literal of the column type.
    """
    if as_of is None:
        anchor = df.select(F.max(ts_col)).scalar()
    elif isinstance(as_of, str) and as_of == "now":
        anchor = F.current_timestamp().cast(df.schema[ts_col].dataType)
    elif isinstance(as_of, str):
        anchor = F.lit(as_of).cast(df.schema[ts_col].dataType)
    else:
        anchor = as_of
    return df.where(F.col(ts_col) >= anchor - F.make_interval(days=F.lit(days)))


def reference_window(
    df: DataFrame,
    days: int = 30,
    fraction: float = 0.1,
    keys: Sequence[str] | None = None,
    ts_col: str = "ts",
    as_of: Column | str | None = None,
    recent: bool = True,
) -> DataFrame:
    """Reference data for drift: the ``days`` before ``as_of`` (see
    ``recent_window``) when the table has a time column, else a stable
    ``fraction`` sample (decided at plan time); all history if not ``recent``."""
    if not recent:
        return df
    if ts_col in df.columns:
        return recent_window(df, days, as_of, ts_col)
    return hash_sample(df, fraction, keys or df.columns)
