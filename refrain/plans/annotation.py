"""Finished part-of-speech reports by decade and genre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions.text import decade
from refrain.operators.annotate import dependency_pairs, prepare_annotated, rake_keywords, top_lemmas
from refrain.operators.genre import genre_long
from refrain.operators.ranking import topk


def lemmas_by_decade(ann: DataFrame, songs: DataFrame, upos: str, k: int = 30) -> DataFrame:
    """The most frequent lemmas of a word class per decade."""
    dated = songs.select("lyrics_id", decade(F.col("year")).alias("decade"))
    return top_lemmas(prepare_annotated(ann, dated), upos, ["decade"], k, index="reverse")


def lemmas_by_genre(ann: DataFrame, songs: DataFrame, genres: list[str], upos: str, k: int = 30) -> DataFrame:
    """The most frequent lemmas of a word class for each chosen genre."""
    tagged = genre_long(songs.select("lyrics_id", *genres), genres)
    tok = prepare_annotated(ann, tagged).filter(F.col("genre_tidy").isNotNull())
    return top_lemmas(tok, upos, ["genre_tidy"], k, index="reverse")


def top_phrases(ann: DataFrame, k: int = 40) -> DataFrame:
    """The most frequent phrases of a subject and its adjective, ties by phrase: ``(term, n)``."""
    return dependency_pairs(ann).orderBy(F.desc("n"), "term").limit(k)


def top_keywords(ann: DataFrame, relevant, k: int = 20, lengths: tuple[int, ...] = (1, 2), **rake) -> DataFrame:
    """The most frequent RAKE keywords of each chosen length."""
    keywords = rake_keywords(ann, relevant, **rake).filter(F.col("ngram").isin(*lengths))
    return topk(keywords, ["ngram"], "freq", k, ["keyword"], index="reverse")
