"""Model selection: grid search on the prepared splits, runs log, publish."""

from __future__ import annotations

import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import schemas
from encore.operators import als, runs
from encore.plans.prepare import Prepared
from encore.sources import files, folders, sinks


def select_model(
    spark: SparkSession,
    prepared: Prepared,
    root: str,
    ranks=als.GRID_RANKS,
    regs=als.GRID_REGS,
    alphas=als.GRID_ALPHAS,
    k: int = als.EVAL_K,
) -> tuple[DataFrame, ALSModel]:
    """Fit the grid on ``train``, score on ``validation``, keep all runs, publish the best.

    Every training has an id of its own: models go to
    ``root/models/training=<id>/run=<n>``, so no earlier model is overwritten,
    and the run records (params, MAP, precision@k, path) are appended to
    ``root/runs``. The best run (highest MAP, earliest on ties) is then
    published: a further record of it gets the next version. Returns this
    training's runs and the best model.
    """
    training = uuid.uuid4().hex
    root = root.rstrip("/")
    table, models = als.grid_search(
        prepared.train, prepared.validation, ranks, regs, alphas, k, model_root=f"{root}/models/training={training}", training=training
    )
    sinks.append_runs(table, f"{root}/runs")
    # the written records, so no run is evaluated again
    mine = spark.read.schema(schemas.RUNS).parquet(f"{root}/runs").where(F.col("training") == training)
    best = runs.best_run(mine)
    publish(spark, root, best)
    return mine.where(F.col("version").isNull()), models[best.first()["run_id"]]


def run_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.RUNS).parquet(f"{root.rstrip('/')}/runs")


def claim_version(spark: SparkSession, root: str) -> int:
    """A version number that no other publisher gets: the first free one above
    those of the log and those claimed, taken by creating ``root/versions/<n>``."""
    root = root.rstrip("/")
    logged = run_log(spark, root).agg(F.max("version")).first()[0] if files.path_exists(spark, f"{root}/runs") else None
    claimed = [int(n) for n in folders.child_names(spark, f"{root}/versions") if n.isdigit()]
    version = max([logged or 0, *claimed]) + 1
    while not folders.create_if_absent(spark, f"{root}/versions/{version}"):
        version += 1
    return version


def publish(spark: SparkSession, root: str, run: DataFrame, path: str | None = None, training: str | None = None) -> int:
    """Append the record that makes ``run`` (one row) the newest version, and return that.

    Publishers at the same time get different versions (``claim_version``);
    one that fails in between leaves a number unused. The row is fixed
    before the log is written to.
    """
    version = claim_version(spark, root)
    row = runs.published(run, version, path, training).select(*schemas.RUNS.fieldNames()).first()
    sinks.append_runs(spark.createDataFrame([row], schemas.RUNS), f"{root.rstrip('/')}/runs")
    return version


def latest_published(spark: SparkSession, root: str) -> DataFrame:
    """``path, version`` of the newest published model in the runs log."""
    return runs.latest_model(run_log(spark, root).where(F.col("path").isNotNull()))
