"""Operators that depend on row order, kept apart so that no group has to fit one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.session import pin

BLOCK_SPAN = 1_000_000


def add_index(df: DataFrame, order_by: list[str], out: str) -> DataFrame:
    """Dense 1..n index in the order of ``order_by``, which must be unique.

    Rows are range-sorted and written once to the checkpoint folder with their partition and their
    place in it; each partition's start is then added from a table with one row per partition.
    """
    part = F.spark_partition_id()
    placed = df.orderBy(*order_by).withColumn("_part", part)
    placed = placed.withColumn(
        "_place", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33)
    )
    placed = pin(placed)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_place") + 1)
        .drop("_part", "_place", "_start")
    )


def _carry_into_blocks(
    blocked: DataFrame, partition: list[str], order: list[str], value: Column, skip_nulls: bool
) -> DataFrame:
    """The last value before each block, for blocks that have one: ``(partition, _block, _carry)``."""
    held = F.when(value.isNotNull(), F.struct(value.alias("v"))) if skip_nulls else F.struct(value.alias("v"))
    place = F.struct(*order)
    tails = blocked.groupBy(*partition, "_block").agg(
        F.max_by(held, F.when(held.isNotNull(), place)).alias("_tail")
    )
    earlier = Window.partitionBy(*partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.last("_tail", ignorenulls=True).over(earlier)
    return tails.select(*partition, "_block", carry.alias("_carry")).filter(F.col("_carry").isNotNull())


def with_previous(
    df: DataFrame,
    partition: list[str],
    order: list[str],
    value: Column,
    out: str,
    block: Column | None = None,
    run: bool = False,
) -> DataFrame:
    """Add the value of the previous row of the same partition, like ``lag``; with ``run``, the last
    value that is not null up to and including this row.

    A partition may be far larger than a task: it is cut into blocks of consecutive rows, each block
    is handled alone, and its first row takes the last value of the blocks before. ``block`` must
    not fall while ``order`` rises; by default the first order column, an integer, is divided by
    ``BLOCK_SPAN``, so that a block holds at most that many rows when the column is unique.
    """
    if block is None:
        block = F.floor(F.col(order[0]) / BLOCK_SPAN)
    blocked = df.withColumn("_block", block)
    window = Window.partitionBy(*partition, "_block").orderBy(*order)
    carry = _carry_into_blocks(blocked, partition, order, value, skip_nulls=run)
    if run:
        here = F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))
        first = F.lit(False)
    else:
        here, first = F.lag(value).over(window), F.row_number().over(window) == 1
    placed = blocked.withColumn(out, here).withColumn("_first", first)
    joined = placed.join(carry, [*partition, "_block"], "left")
    from_before = F.col(out).isNull() if run else F.col("_first")
    return joined.withColumn(
        out, F.when(from_before, F.col("_carry.v")).otherwise(F.col(out))
    ).drop("_block", "_first", "_carry")


def fill_ties(
    df: DataFrame,
    partition: list[str],
    order: list[str],
    col: str,
    fill: str = "prev",
    tie: str = "Tie",
    block: Column | None = None,
) -> DataFrame:
    """Replace the tie marker in a rank column and cast the column to integer.

    ``fill="prev"`` takes the value of the row before, so the second of two markers in a row stays a
    marker and ends as null; ``fill="run"`` takes the last real rank.
    """
    rank = F.col(col)
    if fill == "prev":
        known = with_previous(df, partition, order, rank, "_known", block)
    elif fill == "run":
        real = F.when(rank != tie, rank)
        known = with_previous(df, partition, order, real, "_known", block, run=True)
    else:
        raise ValueError(f"fill must be 'prev' or 'run', not {fill!r}")
    filled = F.when(rank == tie, F.col("_known")).otherwise(rank)
    return known.withColumn(col, filled.try_cast("int")).drop("_known").select(*df.columns)
