"""Top-k, shares and means over groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.operators.sizing import join_totals


def topk(
    df: DataFrame,
    by: list[str],
    measure: str,
    k: int,
    tie_break: list[str] | None = None,
    ties: bool = False,
    index: str | None = None,
) -> DataFrame:
    """The ``k`` rows with the largest ``measure`` of every group.

    Equal measures are ordered by ``tie_break``, or all kept when ``ties`` is set. ``index`` numbers
    the kept rows: ``"asc"`` within each group from the smallest measure up, ``"reverse"`` over the
    whole result from its last row (last group, smallest measure) up. The reverse index orders the
    whole result in one task, so it is for reports of a bounded number of groups.
    """
    tie_break = tie_break or []
    best_first = [F.desc(measure)] + ([] if ties else [F.asc(c) for c in tie_break])
    position = F.rank() if ties else F.row_number()
    kept = (
        df.withColumn("_place", position.over(Window.partitionBy(*by).orderBy(*best_first)))
        .filter(F.col("_place") <= k)
        .drop("_place")
    )
    if index == "asc":
        order = Window.partitionBy(*by).orderBy(F.asc(measure), *[F.desc(c) for c in tie_break])
        return kept.withColumn("order", F.row_number().over(order))
    if index == "reverse":
        return reverse_index(kept, by, measure, tie_break)
    return kept


def reverse_index(df: DataFrame, by: list[str], measure: str, tie_break: list[str], out: str = "x") -> DataFrame:
    """Number a report from its last row up: groups ascending, measure descending."""
    last_first = [F.desc(c) for c in by] + [F.asc(measure)] + [F.desc(c) for c in tie_break]
    return df.withColumn(out, F.row_number().over(Window.orderBy(*last_first)))


def share_of(df: DataFrame, value: str, within: list[str], out: str = "perc") -> DataFrame:
    """Each row's part of its group's total. ``df`` must be aggregated already.

    The totals are summed apart and joined, so a large group is never gathered in one task.
    """
    totals = df.groupBy(*within).agg(F.sum(value).alias("_total"))
    return (
        join_totals(df, totals, within)
        .withColumn(out, F.col(value).cast("double") / F.col("_total").cast("double"))
        .drop("_total")
    )


def mean_by(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Mean of ``value`` per group; nulls do not count."""
    return df.groupBy(*group).agg(F.avg(value).alias(out))


def means_by_each(df: DataFrame, groups: list[str], value: str, out: str) -> DataFrame:
    """Means of ``value`` by each of several columns from one pass: ``(by, group, out)``, the group as text.

    Grouping sets: a row goes to one partial mean per column, and all are shuffled together.
    """
    sets = [[F.col(g)] for g in groups]
    means = df.groupingSets(sets, *groups).agg(F.avg(value).alias(out), F.grouping_id(*groups).alias("_set"))
    which, held = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, g in enumerate(groups):
        mine = F.col("_set") == (1 << len(groups)) - 1 - (1 << (len(groups) - 1 - k))
        which, held = F.when(mine, F.lit(g)).otherwise(which), F.when(mine, F.col(g).cast("string")).otherwise(held)
    return means.select(which.alias("by"), held.alias("group"), out)


def display_order(df: DataFrame, measure: str, tie_break: list[str], out: str = "ord") -> DataFrame:
    """Number the rows of a report by falling ``measure``, for use as a plotting order.

    A mean's last digits depend on the order of its sum, so values equal to nine digits are tied.
    """
    best_first = F.desc(F.round(measure, 9))
    return df.withColumn(out, F.row_number().over(Window.orderBy(best_first, *tie_break)))
