"""Evaluation plans: predictions joined with held-out truth, runs tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators import ranking

POPULARITY_KS = (5, 10, 20)


def popularity_predictions(train: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """Every user gets the top-``k`` most played training items."""
    return ranking.same_list_for_users(users, ranking.popularity_topk(train, k))


def popularity_per_user(train: DataFrame, validation: DataFrame, k: int = 10) -> DataFrame:
    users = validation.select("user_idx").distinct()
    preds = popularity_predictions(train, users, k)
    return ranking.per_user_metrics(preds, validation, k)


def popularity_runs(train: DataFrame, validation: DataFrame, ks: Sequence[int] = POPULARITY_KS) -> DataFrame:
    """Runs table of the popularity ranking for each list length ``k``."""
    runs = None
    for run_id, k in enumerate(ks):
        m = ranking.mean_metrics(popularity_per_user(train, validation, k)).select(
            F.lit(run_id).cast("int").alias("run_id"),
            F.lit(k).cast("int").alias("k"),
            "users_scored",
            "map",
            "precision_at_k",
        )
        runs = m if runs is None else runs.unionByName(m)
    return runs
