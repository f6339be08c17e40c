"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from refrain.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It is computed once, cuts the lineage, survives lost executors, and its size is known to the optimizer.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
