"""File sources: headerless TSV/CSV with fixed schemas, Parquet, batch folders."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore import schemas

log = logging.getLogger(__name__)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "\t",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Headerless delimited text with an explicit schema.

    The schema both names the columns (what ``toDF(names...)`` does after an
    inferred read) and types them, so no inference pass runs. With
    ``corrupt_column`` the reader stays PERMISSIVE and keeps lines that do not
    fit the schema in that column instead of failing the job.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_raw_interactions(spark: SparkSession, path: str) -> DataFrame:
    """Play triplets ``user_id, item_id, plays`` (tab separated)."""
    return read_delimited(spark, path, schemas.RAW_INTERACTIONS, sep="\t")


def read_item_tracks(spark: SparkSession, path: str) -> DataFrame:
    """Item to track pairs (tab separated)."""
    return read_delimited(spark, path, schemas.RAW_ITEM_TRACKS, sep="\t")


def read_item_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Ten-column item metadata (comma separated, quoted fields allowed)."""
    return read_delimited(spark, path, schemas.RAW_ITEM_METADATA, sep=",")


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Give columns new names by position."""
    return df.toDF(*names)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p)) and bool(fs.listStatus(p))


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``; a typed empty frame (and a warning) when absent."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    log.warning("no data at %s", path)
    return spark.createDataFrame([], schema)


def latest_partition(df: DataFrame, partition_col: str = "dt") -> DataFrame:
    """Rows of the newest value of ``partition_col``.

    Written as a filter against a scalar subquery, so on a table partitioned
    by ``partition_col`` only the newest folder is scanned (the max is
    answered from partition values, then used as a partition filter).
    """
    newest = df.select(F.max(partition_col)).scalar()
    return df.where(F.col(partition_col) == newest)


def is_empty(df: DataFrame) -> bool:
    """Emptiness without counting every row (a ``limit 1`` job)."""
    return df.isEmpty()
