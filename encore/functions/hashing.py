"""Stable hash buckets.

``randomSplit``/``sample`` draw per-row random numbers whose assignment
depends on partitioning and row order, so the same table can split
differently on a retry or on another cluster size. A bucket taken from an
md5 of the row key depends on the key alone: a lost executor recomputes the
same split, and DuckDB can reproduce it for the oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(cols: Sequence[str | Column]) -> Column:
    """Text key ``c1|c2|...`` of the given columns (null parts are skipped)."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def hash_unit(cols: Sequence[str | Column]) -> Column:
    """Unsigned 32-bit value from the first 8 hex digits of ``md5(row_key)``."""
    return F.conv(F.substring(F.md5(row_key(cols)), 1, 8), 16, 10).cast("bigint")


def hash_bucket(cols: Sequence[str | Column], buckets: int, method: str = "md5") -> Column:
    """Bucket in ``[0, buckets)`` of the row key.

    ``md5`` (default) can be reproduced outside Spark (the DuckDB oracle
    does); ``xxhash64`` is cheaper per row and also stable, but Spark's own.
    """
    if method not in ("md5", "xxhash64"):
        raise ValueError(f"unknown hash method {method!r}")
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols]), F.lit(buckets)).cast("int")
    return (hash_unit(cols) % F.lit(buckets)).cast("int")
