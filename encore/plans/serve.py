"""Recommendation serving as DataFrame jobs.

Per-request serving (one user id in, a top-K list out) and the batch form
(every user, written to Parquet) share ``als.recommend_users``; an unknown
user yields no row, which a caller reports as not found.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators import als, factorize, topk


def load_model(path: str) -> ALSModel:
    """A saved ALS model, or the ALS stage of a saved pipeline model."""
    try:
        return ALSModel.load(path)
    except Exception:
        return als_stage(PipelineModel.load(path))


def als_stage(model) -> ALSModel:
    """The fitted ALS model itself, or the first ALS stage of a pipeline."""
    if isinstance(model, ALSModel):
        return model
    for stage in getattr(model, "stages", []):
        if isinstance(stage, ALSModel):
            return stage
    raise ValueError("no ALS model among the pipeline stages")


def request_frame(spark: SparkSession, user_ids: list[int], user_col: str = "user_idx") -> DataFrame:
    """Typed one-column frame of requested users (small by construction)."""
    return spark.createDataFrame([(int(u),) for u in user_ids], f"{user_col} int")


def recommend_for(model: ALSModel, requests: DataFrame, k: int = 10) -> DataFrame:
    """``user_idx, recommendations`` (item ids in rank order) for known users."""
    recs = als.recommend_users(model, requests, k).withColumnRenamed("user_idx", "user_id").withColumnRenamed("item_idx", "item_id")
    return topk.recommendation_ids(topk.as_recommendation_lists(recs)).withColumnRenamed("user_id", "user_idx")


def recommend_new(model: factorize.Factors, plays: DataFrame, k: int = 10) -> DataFrame:
    """``user_idx, item_ids`` of users the model may not know, from their plays:
    their vectors are solved against the model's items (``factorize.fold_in``)."""
    recs = factorize.recommend(model, k, factorize.fold_in(plays, model)).withColumnRenamed("user_idx", "user_id").withColumnRenamed("item_idx", "item_id")
    return topk.recommendation_ids(topk.as_recommendation_lists(recs)).withColumnRenamed("user_id", "user_idx")


def recommend_all(model: ALSModel, out_path: str, k: int = 10) -> None:
    """Top-``k`` for every user, in long form, written to Parquet."""
    als.recommend_users(model, None, k).write.mode("overwrite").parquet(out_path)


def found(recs: DataFrame) -> bool:
    """Whether any recommendation came back (one ``limit 1`` job, not a count)."""
    return not recs.isEmpty()


def item_ids(recs: DataFrame) -> DataFrame:
    """Flatten served lists to ``user_idx, rank, item_id``."""
    return recs.select("user_idx", F.posexplode("item_ids").alias("pos", "item_id")).select(
        "user_idx", (F.col("pos") + 1).alias("rank"), "item_id"
    )
