"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's text leaves ``remainder``; false for null ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, fit: Column, rows: int, most_bytes: int) -> DataFrame:
    """``doc_id, body, label`` of at most ``rows`` labelled documents, one row
    each, of at most ``most_bytes`` bytes together.

    ``fit`` says which label rows may be learned from. Documents are taken in
    the order of their doc_id's hash, whole and whatever their length, until the next one
    would exceed a bound; only a text above ``most_bytes`` by itself is passed
    over. Of a repeated doc_id the text with the lowest hash is taken. Only ids, hashes and sizes are
    ordered; the chosen ones (at most ``rows``) are sent to the tasks that read
    the texts, and equal rows are made one before they are exchanged.
    """
    known = labels.where(fit & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    # a doc_id with two labels counts once, by its larger label
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    marked = texts.where(F.col("doc_id").isNotNull() & (F.length("body") <= most_bytes)).withColumn("_hash", F.xxhash64("body"))
    # one row an id before the join, so that a repeated id is no hot key
    each = marked.groupBy("doc_id").agg(F.min(F.struct("_hash", F.length("body").alias("size"))).alias("m"))
    each = each.select("doc_id", "m._hash", "m.size").join(known, "doc_id")
    first = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` short rows, so one task adds up their sizes
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chosen = first.withColumn("_upto", upto).where(F.col("_upto") <= most_bytes).select("doc_id", "_hash", "label")
    return marked.join(F.broadcast(chosen), ["doc_id", "_hash"]).groupBy("doc_id").agg(F.min("body").alias("body"), F.first("label").alias("label"))
