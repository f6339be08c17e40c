"""The joins between chart, lyrics and genre tables.

All are equi joins of tables that grow together, left to shuffled joins; adaptive execution turns
them into broadcast joins where a side proves small and splits frequent keys where it does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.operators.sizing import join_totals

SONG_KEY = ["rank", "year", "song_name", "singer"]


def one_text(rows: DataFrame, keys: list[str], text: str = "lyrics") -> DataFrame:
    """One row per key with its longest text, of equally long ones the last in order; rows with a null key go."""
    best = F.max(F.struct(F.length(text).alias("size"), F.col(text).alias("text")))
    known = rows.filter(" and ".join(f"`{k}` is not null" for k in keys))
    return known.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best.text").alias(text))


def join_chart_lyrics(chart: DataFrame, lyrics: DataFrame, every_text: bool = False) -> DataFrame:
    """Chart rows with the lyrics found under the same title and artist: each different text, or one text.

    A title may have been fetched many times; equal texts are merged before the join, where they would multiply. Without
    ``every_text`` a title gives its longest text alone, so there are at most as many rows as the chart has.
    """
    keys = ["song_name", "singer"]
    known = lyrics.dropna(subset=keys).distinct() if every_text else one_text(lyrics, keys)
    return join_totals(chart, known, keys)


def join_genre(lyrics: DataFrame, genres: DataFrame) -> DataFrame:
    """Lyrics with their genre: rows without one and rows with a missing page go, and a failed
    extraction falls back to the raw text."""
    joined = lyrics.join(genres, SONG_KEY, "left").filter(F.col("genre") != fixed.PAGE_MISSING)
    genre = F.when(F.col("genre") == fixed.EXTRACTION_FAILED, F.col("genre_raw")).otherwise(F.col("genre"))
    return joined.select("rank", "year", "song_name", "singer", "lyrics", "genre_raw", genre.alias("genre"))


def missing_rows(everything: DataFrame, done: DataFrame, keys: list[str] = SONG_KEY) -> DataFrame:
    """Rows of ``everything`` whose key is not in ``done``."""
    return everything.join(done.select(*keys), keys, "left_anti")


def newly_found(chart: DataFrame, have: DataFrame, fetched: DataFrame) -> DataFrame:
    """Chart rows, one per key, that have no lyrics yet and whose title and artist were fetched since."""
    wanted = missing_rows(chart.select(*SONG_KEY).dropDuplicates(), have)
    return join_chart_lyrics(wanted, fetched.select("song_name", "singer", "lyrics"))


def lyrics_fill(chart: DataFrame, have: DataFrame, fetched: DataFrame, every_text: bool = False) -> DataFrame:
    """One round of an incremental fill: what is stored and the rows found since, one per key.

    With ``every_text`` all distinct stored rows stay, and each chart row without lyrics takes every different text
    fetched under its title and artist.
    """
    columns = [*SONG_KEY, "lyrics"]
    if every_text:
        stored = have.select(*columns).distinct()
        wanted = missing_rows(chart.select(*SONG_KEY), stored)
        found = join_chart_lyrics(wanted, fetched.select("song_name", "singer", "lyrics"), every_text=True)
        return stored.unionByName(found.select(*columns))
    return one_text(have, SONG_KEY).select(*columns).unionByName(newly_found(chart, have, fetched).select(*columns))
