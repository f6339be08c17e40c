"""Term frequency times inverse document frequency over any grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.operators.sizing import join_totals

MAX_SMALL_GROUPS = 10_000


def tf_idf(
    counts: DataFrame,
    term: str,
    group: str,
    n: str,
    total: str | None = None,
    n_groups: Column | None = None,
    max_groups: int | None = None,
) -> DataFrame:
    """Add ``tf``, ``idf`` and ``tf_idf`` to a table with one row per group and term.

    tf is the term's part of the group's words, idf the natural log of groups over groups that hold
    the term.

    ``total`` names a column that holds the group's word count already, which saves a join;
    ``n_groups`` gives the number of groups, which saves counting them. ``max_groups`` states how
    many groups the grouping rule can produce at most (six decades, say); only under such a bound
    are the group totals broadcast. The term table grows with the vocabulary and is always joined
    by a shuffle, in which adaptive execution splits the frequent terms.
    """
    # Counting by ``n`` keeps that column in every branch, so that all of them read one exchange.
    per_term = counts.groupBy(term).agg(F.count_if(F.col(n) > 0).alias("_df"))
    if total is None:
        totals = counts.groupBy(group).agg(F.sum(n).alias("_total"))
        if max_groups is not None and max_groups <= MAX_SMALL_GROUPS:
            counts = counts.join(F.broadcast(totals), group)
        else:
            counts = join_totals(counts, totals, [group])
        total = "_total"
        if n_groups is None:
            n_groups = totals.agg(F.count_if(F.col("_total") > 0)).scalar()
    elif n_groups is None:
        n_groups = counts.select(group).distinct().agg(F.count("*")).scalar()
    weighed = join_totals(counts, per_term, [term])
    weighed = weighed.withColumn("tf", F.col(n).cast("double") / F.col(total).cast("double"))
    weighed = weighed.withColumn("idf", F.ln(n_groups.cast("double") / F.col("_df").cast("double")))
    return weighed.withColumn("tf_idf", F.col("tf") * F.col("idf")).drop("_df", "_total")
