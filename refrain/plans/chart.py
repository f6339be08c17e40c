"""Finished table builds: chart from pages, genre from search texts, songs from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import dash_key
from refrain.operators.genre import add_others, clean_genre, extract_genre, genre_fallback, genre_flags
from refrain.operators.ordered import fill_ties
from refrain.sources.html import html_tables, name_cells

CHART_PATH = ["#mw-content-text", "div"]


def chart_rows(pages: DataFrame, key: str = "year") -> DataFrame:
    """The last table of each page as ``(key, row_no, rank, song_name, singer)``, ranks still text."""
    rows = html_tables(pages, key, which=-1, path=CHART_PATH)
    return name_cells(rows.drop("table_no"), ["rank", "song_name", "singer"])


def chart_clean(
    rows: DataFrame, partition: list[str], order: list[str], fill: str = "prev", block: Column | None = None
) -> DataFrame:
    """Chart rows with repaired integer ranks, unquoted titles and search keys.

    ``block`` cuts a partition into pieces of consecutive rows; the page is one where pages are ordered.
    """
    ranked = fill_ties(rows, partition, order, "rank", fill, block=block)
    bare = ranked.withColumn("song_name", F.replace("song_name", F.lit('"'), F.lit("")))
    return bare.withColumn("song_name_dash", dash_key(F.col("song_name")))


def genre_build(df: DataFrame, page_rows: DataFrame | None = None) -> DataFrame:
    """From raw search text and title key to genre, 20 flags and ``others``.

    ``page_rows`` with ``(url, pos, text)`` switches the second-source lookup on.
    """
    cleaned = df.withColumn("_text", clean_genre(F.col("genre_raw")))
    cleaned = cleaned.withColumn("_title", clean_genre(F.col("song_name_dash")))
    found = extract_genre(cleaned, "_text", "_title").drop("_text", "_title")
    if page_rows is not None:
        found = genre_fallback(found, page_rows)
    return add_others(genre_flags(found), fixed.GENRES)
