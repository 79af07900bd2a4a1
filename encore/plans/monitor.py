"""New data -> drift check -> gate -> refresh, once per batch of new data.

``check_and_refresh`` is the batch step; ``monitor_stream`` runs it from
``foreachBatch`` of the ingest stream (trigger ``availableNow`` for a
scheduled run, ``processingTime`` to keep polling). Offsets in the stream
checkpoint decide what is new, so every batch is looked at exactly once
and nothing has to be deleted afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import als, drift, indexing, runs
from encore.plans import train
from encore.session import scratch_path
from encore.sources import files
from encore.sources.folders import BatchTable

NUMERIC = ("plays",)
CATEGORICAL = ("user_id", "item_id")


@dataclass
class Decision:
    report: DataFrame | None  # column, method, score, threshold, drifted
    dataset: dict | None  # n_columns, n_drifted, share, threshold, drifted
    model: ALSModel | None  # refreshed model, when drift was found


def check_and_refresh(
    reference: DataFrame | None,
    new: DataFrame | None,
    history: DataFrame | None,
    run_table: DataFrame,
    users: DataFrame,
    items: DataFrame,
    size: str = "large",
    share: float = drift.DATASET_SHARE,
    mode: str = "union",
    counted: bool = False,
) -> Decision:
    """Drift of ``new`` against ``reference`` (canonical columns); refit when drifted.

    A missing or empty side means no drift and no refit. New interactions
    are mapped to the given indexes; rows with an id outside them take no
    part, so call ``indexing.extend_index`` first to learn new users and items
    (``monitor_stream`` does). Hyper-parameters come from the best run of
    ``run_table``. The report is written once and read back; nothing stays cached.
    ``counted``: ``reference`` holds the ``drift.value_counts`` of the
    reference instead of its rows, which are then not read.
    """
    if reference is None or new is None or files.is_empty(reference) or files.is_empty(new):
        return Decision(None, None, None)
    known = reference if counted else drift.value_counts(reference, NUMERIC, CATEGORICAL)
    counts = drift.paired_counts(known, drift.value_counts(new, NUMERIC, CATEGORICAL))
    report = _written(drift.report_from_counts(counts, NUMERIC, CATEGORICAL, size=size), "drift-report")
    dataset = drift.dataset_drift(report, share).first().asDict()
    if not dataset["drifted"]:
        return Decision(report, dataset, None)
    best = runs.best_run(run_table).first().asDict()
    return Decision(report, dataset, als.refresh(history, indexed(new, users, items), best, mode=mode))


def indexed(new: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``user_idx, item_idx, plays`` of canonical interactions."""
    ids = new.select(F.col("user_id").cast(users.schema["user_id"].dataType), F.col("item_id").cast(items.schema["item_id"].dataType), "plays")
    return ids.join(users, "user_id").join(items, "item_id").select("user_idx", "item_idx", "plays")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Monitor:
    """State that grows with the micro-batches, kept as tables under ``root``.

    ``users`` and ``items`` gain the ids of each batch after the known ones;
    ``history`` gains the batch's indexed interactions, in a folder named
    after the batch, so a replayed batch replaces its own rows. A refit
    therefore sees the first history, every batch so far, and new users.
    The reference's value counts are written once, with the first batch, and its
    rows are not read after that. ``compact_every``: batch folders are
    compacted after that many batches.
    """

    def __init__(
        self, spark: SparkSession, root: str, reference: DataFrame, history: DataFrame, users: DataFrame, items: DataFrame, compact_every: int | None = None
    ) -> None:
        self.spark, self.root, self.reference, self.compact_every = spark, root.rstrip("/"), reference, compact_every
        self.first, self.users, self.items = history.select("user_idx", "item_idx", "plays"), users, items
        self.tables = {kind: BatchTable(spark, f"{self.root}/{kind}", "batch", None) for kind in ("users", "items", "history")}

    def reference_counts(self) -> DataFrame:
        """The kept ``drift.value_counts`` of the reference, counted at the first call."""
        path = f"{self.root}/reference"
        if not files.path_exists(self.spark, f"{path}/_SUCCESS"):
            drift.value_counts(self.reference, NUMERIC, CATEGORICAL).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(drift.PROFILE).parquet(path)

    def _known(self, kind: str, first: DataFrame, upto: int) -> DataFrame:
        """The dictionary with the ids that batches up to ``upto`` added."""
        grown = self.tables[kind].read(upto)
        return first if grown is None else first.unionByName(grown.select(*first.columns))

    def _extend(self, kind: str, first: DataFrame, new: DataFrame, key: str, index: str, batch_id: int) -> DataFrame:
        # a replayed batch does not count what it added before
        added = indexing.extend_index(self._known(kind, first, batch_id - 1), new, key, index)
        added.write.mode("overwrite").parquet(f"{self.root}/{kind}/batch={batch_id}")
        return self._known(kind, first, batch_id)

    def on_batch(self, new: DataFrame, batch_id: int, runs_root: str) -> Decision:
        """Gate and refit for one batch; a refitted model is saved and published."""
        users = self._extend("users", self.users, new, "user_id", "user_idx", batch_id)
        items = self._extend("items", self.items, new, "item_id", "item_idx", batch_id)
        history = self._known("history", self.first, batch_id - 1)
        log = train.run_log(self.spark, runs_root)
        decision = check_and_refresh(self.reference_counts(), new, history, log, users, items, counted=True)
        indexed(new, users, items).write.mode("overwrite").parquet(f"{self.root}/history/batch={batch_id}")
        if decision.model is not None:
            path = f"{self.root}/models/batch={batch_id}"
            decision.model.write().overwrite().save(path)
            train.publish(self.spark, runs_root, runs.best_run(log), path, f"refresh-{batch_id}")
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            for table in self.tables.values():
                # this batch may still be replayed: only those before it
                table.compact(batch_id - 1)
        return decision


def monitor_stream(
    raw: DataFrame,
    reference: DataFrame,
    history: DataFrame,
    runs_root: str,
    users: DataFrame,
    items: DataFrame,
    out_path: str,
    quarantine_path: str,
    checkpoint: str,
    state_path: str,
    play_type: str = "play",
    trigger: dict | None = None,
):
    """Ingest stream whose every micro-batch runs the drift gate on its new plays.

    ``runs_root`` holds the runs log of ``train.select_model``; refreshed
    models are saved under ``state_path/models`` and published there.
    """
    from encore.streaming import ingest

    state = Monitor(raw.sparkSession, state_path, reference, history, users, items)

    def on_batch(new: DataFrame, batch_id: int) -> None:
        state.on_batch(new, batch_id, runs_root)

    return ingest.ingest_plays(raw, out_path, quarantine_path, checkpoint, play_type, trigger=trigger, on_batch=on_batch)
