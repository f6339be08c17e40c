"""Finished sentiment reports by rank, year, decade and genre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import decade, tokens
from refrain.operators.distribution import clip_range, density_by_group
from refrain.operators.genre import genre_long
from refrain.operators.ranking import display_order, mean_by, means_by_each, share_of
from refrain.operators.sentiment import sentiment_relative, song_sentiment
from refrain.operators.sizing import broadcast_if_small
from refrain.operators.words import compute_once, explode_words, word_freq
from refrain.session import pin


def mean_sentiment(songs: DataFrame, lexicon: DataFrame, group: str) -> DataFrame:
    """Mean length-normalised sentiment per rank, year or decade."""
    return mean_by(song_sentiment(songs, lexicon, [group]), [group], "ave_sentiment", "mean_sent")


def mean_sentiments(songs: DataFrame, lexicon: DataFrame, groups: list[str]) -> DataFrame:
    """Mean length-normalised sentiment by each of several attributes; the texts are read and tokenised once."""
    return means_by_each(song_sentiment(songs, lexicon, groups), groups, "ave_sentiment", "mean_sent")


def genre_tidy(songs: DataFrame, lexicon: DataFrame, flags: list[str] = fixed.GENRES) -> DataFrame:
    """One row per song with a sentiment and genre flag set: its sentiment, rank, decade and year."""
    attributed = songs.withColumn("decade", decade(F.col("year")))
    return genre_long(song_sentiment(attributed, lexicon, ["rank", "decade", "year", *flags]), flags)


def mean_sentiment_by_genre(songs: DataFrame, lexicon: DataFrame, flags: list[str] = fixed.GENRES) -> DataFrame:
    """Mean sentiment per genre, numbered from the highest down."""
    means = mean_by(genre_tidy(songs, lexicon, flags), ["genre_tidy"], "ave_sentiment", "mean_sent")
    return display_order(means, "mean_sent", ["genre_tidy"])


def genre_shares(tidy: DataFrame) -> DataFrame:
    """Songs per decade and genre, and their part of the decade's genre marks."""
    counts = tidy.groupBy("decade", "genre_tidy").agg(F.count("*").alias("n_genre_occ"))
    return share_of(counts, "n_genre_occ", ["decade"])


def extreme_songs(
    songs: DataFrame, lexicon: DataFrame, in_decade: str, above: float | None = None, below: float | None = None
) -> DataFrame:
    """Songs of a decade whose sentiment lies beyond a bound, highest first.

    The survivors are written once; while they are few, the song texts stream past them unshuffled.
    """
    dated = songs.withColumn("decade", decade(F.col("year"))).filter(F.col("decade") == in_decade)
    score = F.col("ave_sentiment")
    beyond = score > above if above is not None else score < below
    found = pin(song_sentiment(dated, lexicon, ["decade"]).filter(beyond))
    details = dated.select("lyrics_id", "lyrics", "song_name", "singer", "rank", "year")
    return details.join(broadcast_if_small(found), "lyrics_id").orderBy(F.desc("ave_sentiment"), "lyrics_id")


def sentiment_density(
    scored: DataFrame,
    group: list[str],
    grid: list[float],
    bw: float | None = None,
    clip: tuple[float, float] = fixed.SENTIMENT_AXIS,
) -> DataFrame:
    """Density of the sentiment per group over the clipped axis, every value summed directly."""
    return density_by_group(clip_range(scored, "ave_sentiment", *clip), group, "ave_sentiment", grid, bw, binned=False)


def rank_band(scored: DataFrame, low: int, high: int) -> DataFrame:
    """Scores of the songs ranked ``low`` to ``high``."""
    return scored.filter(F.col("rank").between(low, high))


def words_with_score(songs: DataFrame, lexicon: DataFrame, keep: list[str], key: str = "lyrics_id") -> DataFrame:
    """The words of the songs that hold a lexicon word: ``(keep, words)``, the words as an array.

    The distinct words of each song meet the lexicon in a semi join, whatever its size.
    """
    words = compute_once(songs.select(key, *keep, "lyrics"), tokens(F.col("lyrics")), "words").drop("lyrics")
    distinct = words.select(key, F.explode(F.array_distinct("words")).alias("word"))
    hits = distinct.join(lexicon, "word", "left_semi").select(key).distinct()
    return words.join(hits, key, "left_semi").drop(key)


def emotions_by_genre(songs: DataFrame, lexicon: DataFrame, emotions: DataFrame) -> DataFrame:
    """Emotion profile of each genre over the songs that have a sentiment."""
    scored = words_with_score(songs, lexicon, fixed.GENRES)
    tok = genre_long(scored, fixed.GENRES, "genre").select("genre", explode_words("words", "word"))
    return sentiment_relative(word_freq(tok, ["genre"]), emotions, "genre")
