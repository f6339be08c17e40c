"""Lexical richness: distinct over all words of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions.text import tokens
from refrain.operators.words import compute_once


def richness(words: Column) -> Column:
    """Distinct over all entries of an array; null for an empty one."""
    size = F.size(words)
    return F.when(size > 0, F.size(F.array_distinct(words)).cast("double") / size.cast("double"))


def lexical_richness(tok: DataFrame, key: str, word: str = "word", approx: bool = False) -> DataFrame:
    """Richness per document from a token table, after the caller removed its stop words."""
    distinct = F.approx_count_distinct(word) if approx else F.count_distinct(word)
    share = distinct.cast("double") / F.count("*").cast("double")
    return tok.groupBy(key).agg(share.alias("richness"))


def song_richness(songs: DataFrame, stop: list[str], text: str = "lyrics") -> DataFrame:
    """Richness of each song without its stop words, inside its own row.

    The text goes and the other columns stay; songs left without a word are absent.
    """
    others = [c for c in songs.columns if c != text]
    kept = F.filter(tokens(F.col(text)), lambda w: ~w.isin(stop))
    words = songs.select(*others, kept.alias("_words"))
    return compute_once(words, richness(F.col("_words")), "richness").drop("_words").filter("richness IS NOT NULL")
