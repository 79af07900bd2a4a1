"""Whitening embeddings: distributed covariance, leading components, projection.

Vectors are put on a fixed grid, x = floor(scale * c), so that sums are exact
and equal vectors are equal as numbers. The fit list holds each distinct
vector once: a vector is a short byte string, and equal ones are made one
before the shuffle, so large groups of copies are no hot key.

1. Exact sums by dimension give the mean.
2. Each task adds up the products of its centred vectors; these d x d sums are
   added in two levels (``summed``), so that no task reads one from every other.
3. The leading components of the covariance are found on the driver
   (``eigen``), whose work depends on the dimension alone.
4. Components are sent to the tasks, which project the rows. The components of the
   fit list are measured again: their covariance must be the identity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored
from encore.llm.eigen import leading

#: Numbers of a matrix that travel as one row, and rows of vectors worked on at a time.
PART, ROWS = 1 << 16, 8192
#: Eigenvalues under this share of the trace count as zero: they carry no component.
LEAST = 1e-12
_WIDTHS = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))
_LIMIT = float(1 << 63)


def gridded(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``usable, offsets, x``: which rows have a vector without null or non-finite
    entries (and at least one entry), and the entries of those, floor(scale * c) as
    longs (ends of the long range beyond it)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).cast(pa.float64())
    fine = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(length)), length)
    bad = np.zeros(len(length), bool)
    bad[row[~fine]] = True
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (length > 0) & ~bad
    kept = usable[row]
    with np.errstate(over="ignore"):
        c = np.floor(scale * flat.to_numpy(zero_copy_only=False)[kept])
    # the largest double below 2 ** 63 is a long; what lies beyond becomes the end of the range
    x = np.where(np.abs(c) < _LIMIT, c, 0).astype(np.int64)
    x[c >= _LIMIT], x[c <= -_LIMIT] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    return usable, np.concatenate([[0], np.cumsum(length[usable])]), x


def _sizes(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets, _ = gridded(batch.column("vector"), scale)
        size, n = np.unique(np.diff(offsets), return_counts=True)
        yield pa.record_batch([pa.array(size), pa.array(n)], ["size", "n"])


def _keys(batches: Iterator[pa.RecordBatch], dim: int, scale: float) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes: their entries as little-endian integers, of the least
    width that holds them all, so that equal vectors are equal strings."""
    for batch in batches:
        _, offsets, x = gridded(batch.column("vector"), scale)
        starts = offsets[:-1][np.diff(offsets) == dim]
        x = x[starts[:, None] + np.arange(dim)]
        low, high = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
        left = np.ones(len(x), bool)
        for width in _WIDTHS:
            fits = left & (low >= np.iinfo(width).min) & (high <= np.iinfo(width).max)
            left &= ~fits
            if fits.any():
                raw = x[fits].astype(width).tobytes()
                size = dim * width.itemsize
                yield pa.record_batch([pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())], ["key"])


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The vectors of a fit list as long matrices of at most ``ROWS`` rows."""
    for batch in batches:
        for s in range(0, batch.num_rows, ROWS):
            by_width: dict[int, list[bytes]] = {}
            for key in batch.column("key").slice(s, ROWS).to_pylist():
                by_width.setdefault(len(key) // dim, []).append(key)
            for size, keys in sorted(by_width.items()):
                yield np.frombuffer(b"".join(keys), f"<i{size}").reshape(-1, dim).astype(np.int64)


def _column_sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Exact sums by dimension, split in halves of 32 bits, and the row count as dimension -1."""
    n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
    for x in _matrices(batches, dim):
        n += len(x)
        high += (x >> 32).sum(axis=0)
        low += (x & 0xFFFFFFFF).sum(axis=0)
    place = np.arange(-1, dim, dtype=np.int32)
    yield pa.record_batch([pa.array(place), pa.array(np.append(0, high)), pa.array(np.append(n, low))], ["i", "high", "low"])


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() if TaskContext.get() else 0


def _parts(task: int, total: np.ndarray) -> pa.RecordBatch:
    flat = total.reshape(-1)
    cuts = range(0, len(flat), PART)
    values = [flat[c : c + PART].tobytes() for c in cuts]
    return pa.record_batch(
        [pa.array([task] * len(values), pa.int32()), pa.array(list(range(len(values))), pa.int32()), pa.array(values, pa.binary())], ["task", "part", "total"]
    )


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``slot, part, task`` in, one sum for each slot and part out."""
    key, total = None, None
    schema = pa.schema([("task", pa.int32()), ("part", pa.int32()), ("total", pa.binary())])

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    for batch in batches:
        for slot, part, raw in zip(*(batch.column(c).to_pylist() for c in ("slot", "part", "total"))):
            if key != (slot, part):
                if key is not None:
                    yield row()
                key, total = (slot, part), np.frombuffer(raw, np.float64).copy()
            else:
                total += np.frombuffer(raw, np.float64)
    if key is not None:
        yield row()


def summed(df: DataFrame, term: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of the matrix ``term`` gives for a task's batches.

    Matrices travel in parts of ``PART`` numbers. Tasks are dealt into about
    the square root of their number of slots; the sums by slot are added
    next, in the order of the tasks, so a rerun adds alike.
    """
    spark = df.sparkSession

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _parts(_task(), term(batches))

    ddl = "task int, part int, total binary"
    now = stored(df.mapInArrow(partial, ddl), "whiten-sums")
    tasks = now.select(F.max("task")).first()[0]
    slots = max(1, int(round((tasks + 1) ** 0.5))) if tasks is not None else 1
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for level in (slots, 1):
        dealt = now.withColumn("slot", F.col("task") % level)
        now = dealt.repartition(min(shuffles, level * -(-int(np.prod(shape)) // PART)), "slot", "part").sortWithinPartitions("slot", "part", "task").mapInArrow(_add_parts, ddl)
    out = np.zeros(int(np.prod(shape)))
    for part, raw in now.select("part", "total").collect():
        values = np.frombuffer(raw, np.float64)
        out[part * PART : part * PART + len(values)] = values
    return out.reshape(shape)


@dataclass(frozen=True)
class Whitening:
    """What the rows are projected by; its size depends on the dimension alone."""

    dim: int
    scale: float
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return _mean(self.n, self.sums)


def _mean(n: int, sums: tuple[int, ...]) -> np.ndarray:
    # Python divides integers of any size to the nearest double
    return np.array([s / n for s in sums])


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = rows.schema[vector_col].dataType
    vector = F.col(f"`{vector_col}`")
    if kind.simpleString() not in ("array<float>", "array<double>"):
        vector = vector.cast("array<double>")
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))


def fit_list(rows: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``key``, the distinct vectors on the grid, and their dimension: that of most
    usable rows (ties: the larger)."""
    vectors = _vectors(rows, id_col, vector_col)
    sizes = vectors.select("vector").mapInArrow(lambda it: _sizes(it, scale), "size long, n long").groupBy("size").agg(F.sum("n").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    dim = int(top["size"]) if top else 0
    keys = vectors.select("vector").mapInArrow(lambda it: _keys(it, dim, scale), "key binary") if dim else vectors.select(F.lit(None).cast("binary").alias("key")).limit(0)
    return stored(keys.distinct(), "whiten-fit"), dim


def fit_whitening(rows: DataFrame, most: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """Mean, covariance (divisor n, centred before multiplying) and the ``most``
    leading components of the distinct vectors of ``rows``.

    Fewer components are found in fewer dimensions, and where the
    covariance has fewer eigenvalues above ``LEAST`` times its trace: the rest
    is rounding, which no division makes white. No usable row, or one distinct
    vector: no components.
    """
    keys, dim = fit_list(rows, scale, id_col, vector_col)
    sums = {}
    if dim:
        found = keys.mapInArrow(lambda it: _column_sums(it, dim), "i int, high long, low long")
        halves = found.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
        sums = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in halves.collect()}
    n = sums.pop(-1, 0)
    totals = tuple(sums[i] for i in range(dim)) if n else ()
    if not n:
        return Whitening(dim, scale, 0, (), np.zeros(0), np.zeros((0, dim)), 0.0, 0.0)
    mean = _mean(n, totals)

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((dim, dim))
        for x in _matrices(batches, dim):
            centred = x - mean
            total += centred.T @ centred
        return total

    covariance = summed(keys, products, (dim, dim)) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, components = leading(covariance, most)
    real = values > LEAST * trace if trace > 0 else np.zeros(len(values), bool)
    values, components = values[real], components[real]
    k = len(values)
    scaled = (components / np.sqrt(values)[:, None]).T

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((k + 1, k))
        for x in _matrices(batches, dim):
            w = (x - mean) @ scaled
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        return total

    error = 0.0
    if k:
        total = summed(keys, moments, (k + 1, k)) / n
        error = float(np.max(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k))))
    return Whitening(dim, scale, n, totals, values, components, trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """Sum of (n x - S) ** 2 by row, exact; null where a long cannot hold it."""
    far = float(n) * float(np.max(np.abs(x.astype(np.float64)), initial=0.0)) + float(max(map(abs, sums)))
    if far**2 * x.shape[1] < 2.0**62:
        return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1))
    exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist())
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


PROJECTED_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projected(batches: Iterator[pa.RecordBatch], fit: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(fit.values)
    mean, scaled = fit.mean, (fit.components / np.sqrt(fit.values)[:, None]).T
    explained = fit.values / fit.trace
    for whole in batches:
        for s in range(0, whole.num_rows, ROWS):
            batch = whole.slice(s, ROWS)
            usable, offsets, x = gridded(batch.column("vector"), fit.scale)
            fits = np.diff(offsets) == fit.dim
            rows = np.flatnonzero(usable)[fits]
            x = x[offsets[:-1][fits][:, None] + np.arange(fit.dim)]
            if not len(x):
                continue
            white = (x - mean) @ scaled
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), fit.n)), _deviations(x, fit.n, fit.sums).take(each), pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(each), fit.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whitened(rows: DataFrame, fit: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every usable row of ``rows`` and each component of ``fit``.

    Rows whose vector is null or empty, holds null or non-finite entries, or has
    another length than the fit's are left out. Repeated rows and null ids
    stay; other columns are ignored. ``deviation`` is the exact sum of
    (n x - S) ** 2, null where a long cannot hold it. Components are numbered from 1 by falling
    eigenvalue; a fit without components gives no rows.
    """
    vectors = _vectors(rows, id_col, vector_col)
    if not len(fit.values):
        return rows.sparkSession.createDataFrame([], PROJECTED_DDL)
    return vectors.mapInArrow(lambda it: _projected(it, fit), PROJECTED_DDL)


def whiten(rows: DataFrame, most: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``whitened`` of ``rows`` by their own ``fit_whitening``."""
    return whitened(rows, fit_whitening(rows, most, scale, id_col, vector_col), id_col, vector_col)
