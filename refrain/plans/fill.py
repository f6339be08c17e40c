"""A stored lyrics table that is filled round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators.joins import SONG_KEY, lyrics_fill, newly_found
from refrain.session import pin
from refrain.sources.tables import overwrite_partitions, read_table


def start_store(rows: DataFrame, path: str) -> None:
    """Write a lyrics table in one partition per year, one row per key."""
    overwrite_partitions(lyrics_fill(rows.limit(0), rows, rows.limit(0)), path, ["year"])


def fill_store(chart: DataFrame, fetched: DataFrame, path: str) -> DataFrame:
    """Add the fetched lyrics that the stored table lacks; only the years they belong to are written again.

    Keys alone are compared with the whole table; texts are read of the touched years. Returns the rows added, per year.
    """
    stored = read_table(chart.sparkSession, path)
    found = pin(newly_found(chart, stored, fetched))
    added = found.groupBy("year").agg(F.count("*").alias("added"))
    columns = [*SONG_KEY, "lyrics"]
    touched = stored.join(F.broadcast(added.select("year")), "year", "left_semi")  # years: one row each
    overwrite_partitions(pin(touched.select(*columns).unionByName(found.select(*columns))), path, ["year"])
    return added
