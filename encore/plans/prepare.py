"""Batch preparation: raw interactions -> ids -> splits -> Parquet datasets.

``prepare`` is the end-to-end job; ``Prepared`` keeps the lazy frames so
queries and tests can use the pieces without writing anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import indexing, sampling
from encore.session import scratch_path
from encore.sources import files, sinks, tables

SPLIT_KEYS = ("user_id", "item_id")
SPLIT_WEIGHTS = (0.6, 0.2, 0.2)
SPLIT_NAMES = ("train", "validation", "test")


@dataclass
class Prepared:
    interactions: DataFrame  # user_id, item_id, plays, ts
    users: DataFrame  # user_id, user_idx
    items: DataFrame  # item_id, item_idx
    indexed: DataFrame  # user_idx, item_idx, plays
    train: DataFrame
    validation: DataFrame
    test: DataFrame


def prepare_frames(interactions: DataFrame, n_parts: int | None = None) -> Prepared:
    """Index and split ``interactions`` (canonical columns), lazily.

    The split is taken on raw ``(user_id, item_id)`` so it does not depend
    on the index; each part is then mapped to indexes. Every use of a part
    re-evaluates ``interactions``; ``materialize`` avoids that.
    """
    users, items = indexing.index_pair(interactions, n_parts)
    # the broadcast decision is taken once for the four joins below
    u, i = indexing.broadcast_if_small(users), indexing.broadcast_if_small(items)
    parts = sampling.hash_split(interactions, SPLIT_KEYS, SPLIT_WEIGHTS)
    idx = [indexing.cast_indexed(indexing.index_interactions(p, u, i, broadcast_limit=None)) for p in parts]
    full = indexing.cast_indexed(indexing.index_interactions(interactions, u, i, broadcast_limit=None))
    return Prepared(interactions, users, items, full, *idx)


def materialize(interactions: DataFrame, out_dir: str, n_parts: int | None = None, split: str = "md5") -> Prepared:
    """Label, index and write the interactions; return the written tables.

    The input (at scale a large join) is evaluated once: its rows plus the
    split label go to ``interactions_raw``; both dictionaries come from one
    pass over that table (columnar: two columns read); the indexed rows go
    to ``interactions_full``, partitioned by ``split``, so each consumer of
    a split scans only its folder instead of re-running joins. ``split`` is
    the method of ``sampling.split_label`` (``"random"`` draws rows).
    """
    spark = interactions.sparkSession
    out = out_dir.rstrip("/")
    labelled = sampling.split_label(interactions, SPLIT_KEYS, SPLIT_WEIGHTS, SPLIT_NAMES, method=split)
    sinks.write_overwrite(labelled, f"{out}/interactions_raw")
    raw = spark.read.parquet(f"{out}/interactions_raw")
    users, items = indexing.index_pair(raw, n_parts)
    indexed = indexing.index_interactions(raw, users, items, keep=("plays", "split"))
    sinks.write_overwrite(indexing.cast_indexed(indexed, keep=("split",)), f"{out}/interactions_full", ["split"])
    return load_prepared(spark, out, users, items)


def prepare_once(interactions: DataFrame, out_dir: str, n_parts: int | None = None, split: str = "md5") -> Prepared:
    """``materialize`` for a single consumer: the raw rows are written and the
    dictionaries built, but the indexed rows stay lazy, joined when they are read."""
    spark = interactions.sparkSession
    path = f"{out_dir.rstrip('/')}/interactions_raw"
    sinks.write_overwrite(sampling.split_label(interactions, SPLIT_KEYS, SPLIT_WEIGHTS, SPLIT_NAMES, method=split), path, ["split"])
    raw = spark.read.parquet(path)
    users, items = indexing.index_pair(raw, n_parts)
    # the broadcast decision is taken once for all parts
    u, i = indexing.broadcast_if_small(users), indexing.broadcast_if_small(items)
    full = indexing.cast_indexed(indexing.index_interactions(raw, u, i, keep=("plays", "split"), broadcast_limit=None), keep=("split",))
    part = [full.where(F.col("split") == name).drop("split") for name in SPLIT_NAMES]
    return Prepared(raw.drop("split"), users, items, full.drop("split"), *part)


def prepare_tables(spark: SparkSession, sf_dir: str, n_parts: int | None = None, once: bool = False) -> Prepared:
    """``materialize`` the interactions of the given tables into scratch space
    (``once``: ``prepare_once``, for a query that reads one part one time)."""
    return (prepare_once if once else materialize)(tables.interactions(spark, sf_dir), scratch_path(spark, "prepared"), n_parts)


def write_datasets(interactions: DataFrame, tracks: DataFrame, metadata: DataFrame, out_dir: str, split: str = "md5") -> Prepared:
    """Write the prepared datasets under ``out_dir`` and return them read back.

    ``interactions_raw`` holds the raw ids with the split label;
    ``interactions_full`` the indexed rows, partitioned by ``split``
    (``train``/``validation``/``test``); also ``users``, ``items``,
    ``item_tracks`` and ``metadata`` (nullable ``item_idx``).
    """
    out = out_dir.rstrip("/")
    p = materialize(interactions, out, split=split)
    sinks.write_overwrite(p.users, f"{out}/users")
    sinks.write_overwrite(p.items, f"{out}/items")
    sinks.write_overwrite(indexing.attach_item_index(tracks, p.items), f"{out}/item_tracks")
    sinks.write_overwrite(indexing.attach_item_index(metadata, p.items), f"{out}/metadata")
    return load_prepared(interactions.sparkSession, out)


def prepare(spark: SparkSession, sf_dir: str, out_dir: str) -> Prepared:
    """``write_datasets`` of the given tables."""
    return write_datasets(tables.interactions(spark, sf_dir), tables.item_tracks(spark, sf_dir), tables.item_metadata(spark, sf_dir), out_dir)


def prepare_files(spark: SparkSession, interactions: str, tracks: str, metadata: str, out_dir: str, split: str = "md5") -> Prepared:
    """``write_datasets`` of raw text files: play triplets and item-track pairs
    (TSV), item metadata (CSV). Lines without both ids take no part."""
    plays = files.read_raw_interactions(spark, interactions).dropna(subset=["user_id", "item_id"])
    return write_datasets(plays, files.read_item_tracks(spark, tracks), files.read_item_metadata(spark, metadata), out_dir, split)


def write_reference(interactions: DataFrame, path: str, **options) -> DataFrame:  # noqa: ANN003
    """Write the reference data of the drift check and return it read back;
    ``options`` are those of ``sampling.reference_window``."""
    sinks.write_overwrite(sampling.reference_window(interactions, **options), path)
    return interactions.sparkSession.read.parquet(path)


def load_prepared(spark: SparkSession, out_dir: str, users: DataFrame | None = None, items: DataFrame | None = None) -> Prepared:
    """Prepared datasets as written by ``materialize``/``prepare``."""
    out = out_dir.rstrip("/")
    full = spark.read.parquet(f"{out}/interactions_full")
    part = [full.where(F.col("split") == name).drop("split") for name in SPLIT_NAMES]
    return Prepared(
        spark.read.parquet(f"{out}/interactions_raw").drop("split"),
        users if users is not None else spark.read.parquet(f"{out}/users"),
        items if items is not None else spark.read.parquet(f"{out}/items"),
        full.drop("split"),
        *part,
    )
