"""Tokens and word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions.text import tokens
from refrain.operators.sizing import broadcast_if_small


def compute_once(df: DataFrame, expr: Column, out: str) -> DataFrame:
    """Add a costly column that is computed exactly once per row.

    The optimizer moves a filter on a plain computed column below it by computing the column again
    for the filter; it cannot move one past a generator.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(out))


def unnest_tokens(
    df: DataFrame, out: str, col: str, keep_pos: bool = False, length: str | None = None
) -> DataFrame:
    """One row per word of ``col``; the other columns stay, the text goes.

    ``keep_pos`` adds the position ``pos`` from 0, ``length`` a column with the text's word count.
    """
    others = [c for c in df.columns if c != col]
    words = df.select(*others, tokens(F.col(col)).alias("_words"))
    if length:
        words = words.withColumn(length, F.size("_words"))
        others.append(length)
    # Outer, then filtered: for a plain explode the optimizer adds a filter on the array's size below,
    # which would tokenise the text a second time.
    place = [F.posexplode_outer("_words").alias("pos", out)] if keep_pos else [explode_words("_words", out)]
    return words.select(*others, *place).filter(F.col(out).isNotNull())


def explode_words(words: str | Column, out: str) -> Column:
    """One row per word, and a null word for a text without any, which the caller filters out."""
    return F.explode_outer(words).alias(out)


def text_words(col: str, stop: list[str]) -> Column:
    """The words of a text that are no stop words, as an array."""
    return F.filter(tokens(F.col(col)), lambda w: ~w.isin(stop))


def remove_stopwords(tok: DataFrame, stop: DataFrame | list[str], word: str = "word") -> DataFrame:
    """Drop stop words. A Python list becomes a filter; a table becomes an anti join."""
    if isinstance(stop, list):
        return tok.filter(~F.col(word).isin(stop))
    return tok.join(broadcast_if_small(stop.select(word)), word, "left_anti")


def drop_words(tok: DataFrame, words: list[str], word: str = "word") -> DataFrame:
    """Drop an extra list of words."""
    return tok.filter(~F.col(word).isin(words))


def word_freq(
    tok: DataFrame, by: list[str] | None = None, word: str = "word", out: str = "n", top: int | None = None
) -> DataFrame:
    """Occurrences per word, or per group and word; ``top`` keeps the most frequent overall."""
    counts = tok.groupBy(*(by or []), word).agg(F.count("*").alias(out))
    return counts.orderBy(F.desc(out), *(by or []), word).limit(top) if top else counts


def document_counts(df: DataFrame, words: str, word: str = "word", out: str = "n") -> DataFrame:
    """Occurrences per document row and word, without a shuffle.

    ``words`` is an array column; every row must be one whole document, under its own id. The array
    is sorted and cut where the word changes, so a text is counted inside its own row. The other
    columns stay beside each count.
    """
    others = [c for c in df.columns if c != words]
    ordered = df.select(*others, F.sort_array(words).alias("_sorted"))
    changes = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    cut = ordered.withColumn("_starts", changes)
    ends = F.concat(F.slice("_starts", 2, F.size("_sorted") + 1), F.array(F.size("_sorted")))
    runs = F.zip_with(
        "_starts",
        ends,
        lambda a, b: F.struct(F.get("_sorted", a).alias(word), (b - a).cast("bigint").alias(out)),
    )
    counts = cut.select(*others, runs.alias("_runs")).select(*others, F.inline_outer("_runs"))
    return counts.filter(F.col(word).isNotNull())
