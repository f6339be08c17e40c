"""Exact, seeded samples and splits that do not sort the table."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from refrain.operators.ordered import add_index


def hash_order(key: str, seed: int | str) -> Column:
    """A pseudo-random but reproducible order: by md5 of key and seed, then by key.

    Steps that follow each other need seeds of their own, else the second repeats the order of the first.
    """
    return F.struct(
        F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))).alias("h"), F.col(key).alias("k")
    )


BIN_DIGITS = 3


def _hashed(df: DataFrame, key: str, seed: int | str, stratum: Column) -> DataFrame:
    order = hash_order(key, seed)
    hashed = df.select(stratum.alias("stratum"), order.alias("o"))
    return hashed.withColumn("bin", F.substring("o.h", 1, BIN_DIGITS))


def cut_offs(
    df: DataFrame, key: str, seed: int | str, wanted: Callable[[dict], dict], stratum: Column
) -> dict[object, Row | None]:
    """For each stratum the last row, in hash order, of the ``wanted`` number of rows; None if there is none.

    ``wanted`` gets the rows of every stratum and returns the sizes of the samples. All strata share one histogram of
    hash prefixes, at most ``16 ** BIN_DIGITS`` rows per stratum, from which the driver reads the bin that holds each
    cut; only those bins are ranked, a ``16 ** BIN_DIGITS``-th of the table. Strata have to be few, such as labels.
    """
    hashed = _hashed(df, key, seed, stratum)
    bins: dict[object, list[tuple[str, int]]] = {}
    for row in hashed.groupBy("stratum", "bin").agg(F.count("*").alias("n")).collect():
        bins.setdefault(row.stratum, []).append((row.bin, row.n))
    sizes = wanted({value: sum(n for _, n in held) for value, held in bins.items()})
    inside, cuts = F.lit(False), dict.fromkeys(bins)
    places = F.lit(None).cast("long")
    for value, held in bins.items():
        left = sizes.get(value, 0)
        for prefix, n in sorted(held):
            if 0 < left <= n:
                hit = F.col("stratum").eqNullSafe(F.lit(value)) & (F.col("bin") == prefix)
                inside, places = inside | hit, F.when(hit, F.lit(left)).otherwise(places)
            left -= n
    place = F.row_number().over(Window.partitionBy("stratum", "bin").orderBy("o"))
    ranked = hashed.filter(inside).withColumn("_at", place).filter(F.col("_at") == places)
    return cuts | {row.stratum: row.o for row in ranked.select("stratum", "o").collect()}


def sampled(cuts: dict[object, Row | None], key: str, seed: int | str, stratum: Column) -> Column:
    """Whether a row is in the sample of its stratum: row-local."""
    order, kept = hash_order(key, seed), F.lit(False)
    for value, cut in cuts.items():
        if cut is not None:
            last = F.struct(F.lit(cut.h).alias("h"), F.lit(cut.k).alias("k"))
            kept = F.when(stratum.eqNullSafe(F.lit(value)), order <= last).otherwise(kept)
    return F.coalesce(kept, F.lit(False))


def mark_train(
    df: DataFrame, key: str, frac: float, seed: int | str, out: str = "is_train", stratum: str | None = None
) -> DataFrame:
    """Flag an exact ``floor(frac * n)`` rows as training rows, of the table or of each value of ``stratum``.

    ``key`` must be unique.
    """
    by = F.col(stratum) if stratum else F.lit(0)
    cuts = cut_offs(df, key, seed, lambda rows: {v: math.floor(frac * n) for v, n in rows.items()}, by)
    return df.withColumn(out, sampled(cuts, key, seed, by))


def mark_train_approx(df: DataFrame, key: str, frac: float, seed: int | str, out: str = "is_train") -> DataFrame:
    """Flag about ``frac`` of the rows by a hash threshold: row-local, no pass over the table before."""
    leading = F.conv(F.substring(hash_order(key, seed)["h"], 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, leading < int(frac * 2**32))


def train_test_split(df: DataFrame, key: str, frac: float, seed: int | str) -> tuple[DataFrame, DataFrame]:
    """An exact seeded split into a training set and the rest."""
    marked = mark_train(df, key, frac, seed, "_train")
    return (
        marked.filter("_train").drop("_train"),
        marked.filter("NOT _train").drop("_train"),
    )


def class_balance(df: DataFrame, flag: str, key: str, seed: int | str, label: str = "label") -> DataFrame:
    """All rows with ``flag`` 1 and equally many of those with 0, labelled 1.0 and 0.0.

    With fewer negatives than positives every negative is kept. ``key`` must be unique.
    """
    rows = df.filter(F.col(flag).isin(0, 1))
    by = F.col(flag).cast("int")
    cuts = cut_offs(rows, key, seed, lambda n: {1: n.get(1, 0), 0: min(n.get(0, 0), n.get(1, 0))}, by)
    kept = rows.filter(sampled(cuts, key, seed, by))
    return kept.withColumn(label, F.col(flag).cast("double"))


def fold_numbers(df: DataFrame, key: str, label: str, folds: int, seed: int | str, out: str = "fold") -> DataFrame:
    """``(key, label, fold)`` with folds 0 to ``folds`` - 1 that are balanced within each label and altogether.

    Rows are numbered by label and hash and dealt out in turn, so two folds differ by one row at most, and by one in
    each label. ``key`` must be unique.
    """
    ordered = add_index(df.select(key, label, hash_order(key, seed)["h"].alias("_h")), [label, "_h", key], "_index")
    return ordered.select(key, label, ((F.col("_index") - 1) % folds).cast("int").alias(out))
