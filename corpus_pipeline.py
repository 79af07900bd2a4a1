"""A training-corpus pipeline over ``documents``: each stage calls one operator.

Every stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.llm.common import stored
from encore.llm.decontaminate import drop_contaminated_rows
from encore.llm.mix import mixed
from encore.llm.queries import TOKENIZER
from encore.llm.simhash import keep_one
from encore.llm.token_files import token_files
from encore.llm.toxicity import drop_toxic, fit_toxicity, is_held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    return drop_toxic(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels"), ~is_held_out()), least=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the smallest doc_id."""
    return keep_one(docs, words=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of a benchmark item's five-word shingles
    go, each row judged by its own text."""
    return drop_contaminated_rows(docs, _table(spark, sf_dir, "benchmark"), size=5, share=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed(docs, weights=(5, 2, 1), share=1.0, most=3.0)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; a row for each document of the mix, from the files."""
    return token_files(docs, TOKENIZER, end_id=0)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("token files", token_output),
]

#: SQL has no XXH64 and no learned scores: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
