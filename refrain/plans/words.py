"""Finished word reports: frequencies, TF-IDF and richness by decade, genre and artist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import WORD_CHAR, decade, tokens
from refrain.operators.genre import filter_flag, genre_long
from refrain.operators.ranking import reverse_index, topk
from refrain.operators.richness import song_richness
from refrain.operators.sizing import broadcast_if_small, natural_join
from refrain.operators.tfidf import tf_idf
from refrain.operators.words import (
    document_counts,
    drop_words,
    explode_words,
    remove_stopwords,
    unnest_tokens,
    word_freq,
)


def top_words(songs: DataFrame, stop: list[str], k: int = 25) -> DataFrame:
    """The most frequent words without stop words."""
    tok = unnest_tokens(songs.select("lyrics"), "word", "lyrics")
    return word_freq(remove_stopwords(tok, stop), top=k)


def cloud_words(songs: DataFrame, stop: DataFrame) -> DataFrame:
    """Frequencies of every word but stop words and fillers, most frequent first.

    Stop words leave after the count, one row per word instead of one per token.
    """
    tok = unnest_tokens(songs.select("lyrics"), "word", "lyrics")
    counted = word_freq(drop_words(tok, fixed.CLOUD_DROP), out="freq")
    return natural_join(counted, broadcast_if_small(stop), "left_anti").orderBy(F.desc("freq"), "word")


def words_by_decade(songs: DataFrame, stop: list[str], k: int = 25) -> DataFrame:
    """The most frequent words of each decade."""
    tok = unnest_tokens(songs.select(decade(F.col("year")).alias("decade"), "lyrics"), "word", "lyrics")
    return topk(word_freq(remove_stopwords(tok, stop), ["decade"]), ["decade"], "n", k, ["word"], index="reverse")


def words_of_genre(songs: DataFrame, flag: str, stop: list[str], k: int = 25) -> DataFrame:
    """The most frequent words of the songs with one genre flag."""
    return top_words(filter_flag(songs, flag), stop, k)


def words_of_singer(songs: DataFrame, singer: str, stop: list[str], k: int = 25) -> DataFrame:
    """The most frequent words of one artist."""
    return top_words(songs.filter(F.col("singer") == singer), stop, k)


def top_artists(songs: DataFrame, k: int = 10) -> DataFrame:
    """The artists with most chart rows."""
    return songs.groupBy("singer").agg(F.count("*").alias("num")).orderBy(F.desc("num"), "singer").limit(k)


def song_tf_idf(songs: DataFrame, key: str = "lyrics_id") -> DataFrame:
    """TF-IDF of every word of every song. Counts and lengths come from the song's own row; the only
    shuffles are the term table and the join with it."""
    words = songs.select(key, tokens(F.col("lyrics")).alias("_words")).withColumn("_len", F.size("_words"))
    counts = document_counts(words, "_words")
    n_songs = songs.agg(F.count_if(F.col("lyrics").rlike(WORD_CHAR))).scalar()
    return tf_idf(counts, "word", key, "n", total="_len", n_groups=n_songs).drop("_len")


def tf_idf_by_song(songs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` heaviest words of each song, with its name."""
    top = topk(song_tf_idf(songs), ["lyrics_id"], "tf_idf", k, ["word"])
    return top.join(songs.select("lyrics_id", "song_name"), "lyrics_id")


def chosen_songs(top: DataFrame, ids: list[int]) -> DataFrame:
    """The TF-IDF report of a few songs, numbered for plotting."""
    return reverse_index(top.filter(F.col("lyrics_id").isin(ids)), ["lyrics_id"], "tf_idf", ["word"])


def _top_tf_idf(tok: DataFrame, group: str, k: int, max_groups: int | None = None) -> DataFrame:
    weighed = tf_idf(word_freq(tok, [group]), "word", group, "n", max_groups=max_groups)
    return topk(weighed, [group], "tf_idf", k, ["word"])


def tf_idf_by_decade(songs: DataFrame, k: int = 20) -> DataFrame:
    """The heaviest words of each decade."""
    tok = unnest_tokens(songs.select(decade(F.col("year")).alias("decade"), "lyrics"), "word", "lyrics")
    top = _top_tf_idf(tok, "decade", k, max_groups=len(fixed.DECADES) + 1)
    return reverse_index(top, ["decade"], "tf_idf", ["word"])


def tf_idf_by_genre(songs: DataFrame, flags: list[str], genres: list[str], k: int = 20) -> DataFrame:
    """The heaviest words of the chosen genres, weighed against all genres."""
    words = songs.select(*flags, tokens(F.col("lyrics")).alias("_words"))
    tok = genre_long(words, flags).select("genre_tidy", explode_words("_words", "word")).filter("word IS NOT NULL")
    top = _top_tf_idf(tok, "genre_tidy", k, max_groups=len(flags))
    return reverse_index(top.filter(F.col("genre_tidy").isin(genres)), ["genre_tidy"], "tf_idf", ["word"])


def tf_idf_by_singer(songs: DataFrame, k: int = 20) -> DataFrame:
    """The heaviest words of each artist, weighed against all artists."""
    return _top_tf_idf(unnest_tokens(songs.select("singer", "lyrics"), "word", "lyrics"), "singer", k)


def tf_idf_of_top_artists(songs: DataFrame, artists: int = 10, k: int = 20) -> DataFrame:
    """The same report for the artists with most chart rows."""
    chosen = top_artists(songs, artists).select("singer")
    top = tf_idf_by_singer(songs, k).join(F.broadcast(chosen), "singer", "left_semi")
    return reverse_index(top, ["singer"], "tf_idf", ["word"])


def richness_by_decade(songs: DataFrame, stop: list[str]) -> DataFrame:
    """Mean lexical richness per decade."""
    rich = song_richness(songs.select(decade(F.col("year")).alias("decade"), "lyrics"), stop)
    return rich.groupBy("decade").agg(F.avg("richness").alias("avg_richness"))


def richness_by_genre_decade(songs: DataFrame, genres: list[str], stop: list[str]) -> DataFrame:
    """Mean lexical richness per genre and decade for the chosen genres."""
    rich = song_richness(songs.select(decade(F.col("year")).alias("decade"), *genres, "lyrics"), stop)
    return genre_long(rich, genres).groupBy("genre_tidy", "decade").agg(F.avg("richness").alias("avg_richness"))
