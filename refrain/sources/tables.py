"""Stored tables in and out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANNOTATED = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("paragraph_id", T.LongType()),
        T.StructField("sentence_id", T.LongType()),
        T.StructField("token_id", T.LongType()),
        T.StructField("token", T.StringType()),
        T.StructField("lemma", T.StringType()),
        T.StructField("upos", T.StringType()),
        T.StructField("head_token_id", T.LongType()),
        T.StructField("dep_rel", T.StringType()),
    ]
)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options: str) -> DataFrame:
    """Read a stored table: parquet, ORC, JSON or CSV."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that comes in fewer pieces than there are cores.

    A few unsplittable files would otherwise be tokenised by as few tasks. Large tables have more
    pieces than cores and pass through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Overwrite a stored table. Partitioned output is rebalanced first, so that each value gets few
    files while a frequent value is still written by several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions that ``df`` has rows of and leave the files of all others as they are.

    ``df`` may be derived from the table itself if it is pinned.
    """
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns, cast to its types; a missing one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_annotated(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a part-of-speech annotated token table, one row per token."""
    return require_columns(read_table(spark, path, fmt), ANNOTATED)


def collect_by_key(frames: Mapping[object, DataFrame], key: str) -> DataFrame:
    """Stack one frame per key value, with the value as a literal column."""
    out = None
    for value, frame in frames.items():
        part = frame.withColumn(key, F.lit(value))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to stack")
    return out
