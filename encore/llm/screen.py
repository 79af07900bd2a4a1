"""Bit arrays of bounded size that screen rows inside tasks, before a shuffle.

A screen holds every value it was built from and passes some others, so it may
only stand in front of an exact join or check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_screen(df: DataFrame, column: str, least_bits: int = 16, most_bits: int = 28) -> np.ndarray:
    """A bit array that holds every value (64-bit hashes) of ``column``: 16 bits a
    row, but at most 2 ** ``most_bits``, so its size is bounded; false passes grow beyond that."""
    rows = df.count()
    bits = min(most_bits, max(least_bits, int(16 * max(rows, 1)).bit_length()))
    cell = F.shiftrightunsigned(column, 64 - bits)
    words = df.select(F.shiftrightunsigned(cell, 5).alias("w"), F.call_function("shiftleft", F.lit(1), (cell % 32).cast("int")).alias("b"))
    packed = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[packed.column("w").to_numpy()] = packed.column("b").to_numpy().view(np.uint32)
    return out


def passes(screen: np.ndarray, h: np.ndarray) -> np.ndarray:
    cell = h >> np.uint64(64 - (len(screen).bit_length() - 1 + 5))
    return (screen[cell >> np.uint64(5)] >> (cell & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def screened(screen: np.ndarray, column: str) -> Column:
    """Whether the 64-bit hash in ``column`` passes."""

    @F.arrow_udf("boolean")
    def passed(h: pa.Array) -> pa.Array:
        return pa.array(passes(screen, h.to_numpy().view(np.uint64)))

    return passed(column)
