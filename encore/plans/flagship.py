"""Flagship: index -> split -> implicit ALS -> top-10 -> per-user metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import als, ranking
from encore.plans.prepare import prepare_tables

FLAGSHIP_RANK, FLAGSHIP_REG, FLAGSHIP_ALPHA, FLAGSHIP_K = 32, 0.01, 40.0, 10


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per validation user: ``user_idx, n_pred, n_truth, hits_at_k`` and metrics."""
    p = prepare_tables(spark, sf_dir)
    model = als.train_als(p.train, FLAGSHIP_RANK, FLAGSHIP_REG, FLAGSHIP_ALPHA)
    users = p.validation.select("user_idx").distinct()
    preds = als.recommend_users(model, users, FLAGSHIP_K)
    per_user = ranking.per_user_metrics(preds, p.validation, FLAGSHIP_K)
    return per_user.select(
        "user_idx",
        F.col("n_pred").cast("bigint").alias("n_pred"),
        "n_truth",
        "hits_at_k",
        *[F.round(m, 6).alias(m) for m in ranking.METRICS],
    )
