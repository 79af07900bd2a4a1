"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir, scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage and fixes the rows: a lost executor rereads the files
    instead of repeating what made them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with the place of each row, and that column's name.

    Rows read from Parquet files are told apart by file and row number in
    the file, which every job sees alike, however the files are split. Other rows are
    stored once, and placed by the files they are stored in.
    """
    place, taken = "_place", {c.lower() for c in docs.columns}
    while place in taken:
        place += "_"
    try:
        file = docs.metadataColumn("_metadata")
        path = file["file_path"]
        # 128 bits of the path stand for it: a table has millions of files at most
        at = F.struct(F.xxhash64(path).alias("f"), F.xxhash64(F.reverse(path)).alias("g"), file["row_index"].alias("i"))
        return docs.withColumn(place, at), place
    except AnalysisException:
        return placed(stored(docs, name), name)


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``body`` (UTF-8 bytes; null text: empty) alone, so
    that other columns of ``docs``, whatever their names, cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The values of a binary column as Python bytes."""
    return column.to_pylist()


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the offsets of its rows."""
    col = column.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``most`` bytes of ``column``
    (a row above that is a piece of its own), so that working arrays, which
    are multiples of the text, stay bounded whatever Spark's batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column).cast(pa.large_binary())
        ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset + 1 : col.offset + len(col) + 1]
        base = int(np.frombuffer(col.buffers()[1], np.int64)[col.offset])
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            base = int(ends[stop - 1])
            start = stop
