"""Joins whose small side is broadcast only after its size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows, else return it as it is.

    Meant for narrow lookup tables such as word lists and lexicons. A table over the bound is left
    to a shuffled join, which adaptive execution splits where a key is frequent.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name both sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two sides share no column")
    return left.join(right, shared, how)


def join_totals(rows: DataFrame, totals: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table that was aggregated by the join keys.

    Spark would keep the aggregate's partitioning for the join, and adaptive execution then cannot
    split a frequent key. The keys are therefore joined as one computed string: the aggregate, one
    row per key, is shuffled once more, and the rows of a frequent key spread over several tasks.
    Keys must not be null.
    """
    key = F.concat_ws("\u001f", *[F.col(k).cast("string") for k in keys])
    keyed = totals.withColumn("_key", key).drop(*keys)
    return rows.withColumn("_key", key).join(keyed, "_key", how).drop("_key")
