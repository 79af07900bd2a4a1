"""The registered query of each operator: its whole table, production
parameters, and the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import decontaminate, licenses, mix, pii, quality_mil
from encore.llm.quality_rules import quality_rules
from encore.llm.secret_scan import BASE_RULES, digest, find_secrets
from encore.llm.simhash import simhash_dedup
from encore.llm.spelling import spelling_groups
from encore.llm.suffix_dedup import suffix_dedup
from encore.llm.token_files import token_files
from encore.llm.toxicity import fit_toxicity, is_held_out, score_toxicity
from encore.llm.whiten import whiten

#: The vocabulary of the public byte-level tokenizer; a path on every machine.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3.0).select("doc_id", "size", "source_size", "target", "taken")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_table(spark, sf_dir, "documents"), words=4, radius=4)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(_table(spark, sf_dir, "documents")), [r.kind for r in BASE_RULES])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=5, share=0.8)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_mil.fit_quality(docs, _table(spark, sf_dir, "labels"), ~quality_mil.is_held_out())
    scored = quality_mil.score_quality(docs, model)
    return scored.select("doc_id", quality_mil.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"), ~is_held_out())
    return score_toxicity(docs, model).select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
    return quality_rules(_table(spark, sf_dir, "documents")).select(*columns)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), TOKENIZER, end_id=0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.digest(pii.find_pii(docs, pii.fit_pii(docs)))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), most=4, scale=256.0)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.find_licenses(_table(spark, sf_dir, "documents"), licenses.TEMPLATES))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(_table(spark, sf_dir, "documents"), modulus=199, least_length=6, least_count=5, ratio=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_simhash": op2_simhash,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_files": op9_token_files,
    "op10_pii": op10_pii,
    "op11_whiten": op11_whiten,
    "op12_licenses": op12_licenses,
    "op13_spelling": op13_spelling,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
SQL: dict[str, str] = {
    "op1_mix": mix.SQL,
    "op4_decontaminate": decontaminate.SQL,
}
