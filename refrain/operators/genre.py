"""Genre text to genre: cleaning, extraction, fallback, flags and the long form."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import replace_chain
from refrain.operators.sizing import join_totals


def clean_genre(col: Column) -> Column:
    """The genre text clean: bracketed text, "and" forms, "the", "-ing" forms, then dashes."""
    return replace_chain(col, fixed.GENRE_CLEAN)


def extract_genre(df: DataFrame, text: str, title: str, out: str = "genre") -> DataFrame:
    """Cut the genre out of a cleaned search text.

    With "Genre" and "Length" the genre stands between them; with "Genre" after the title, it stands
    behind the title's prefix; other texts get a failure label. The title is read as a pattern.
    """
    source = F.col(text)
    prefix = F.concat(F.lit(fixed.BEFORE_TITLE), F.col(title), F.lit(fixed.AFTER_TITLE))
    has_genre = source.contains(fixed.GENRE_MARK)
    genre = (
        F.when(has_genre & source.contains(fixed.LENGTH_MARK), F.regexp_replace(source, fixed.AROUND_GENRE, ""))
        .when(has_genre & F.regexp_like(source, prefix), F.regexp_replace(source, prefix, F.lit("")))
        .when(has_genre, fixed.EXTRACTION_FAILED)
        .otherwise(fixed.NO_GENRE)
    )
    return df.withColumn(out, genre)


def genre_status(genre: Column) -> Column:
    """"ok", or the failure label that stands in the genre column."""
    failures = [fixed.EXTRACTION_FAILED, fixed.NO_GENRE, fixed.PAGE_MISSING]
    return F.when(genre.isin(failures), genre).otherwise("ok")


def extraction_failures(df: DataFrame, genre: str = "genre") -> DataFrame:
    """The rows whose extraction failed."""
    return df.filter(F.col(genre).isin(fixed.EXTRACTION_FAILED, fixed.NO_GENRE))


def extraction_report(df: DataFrame, genre: str = "genre") -> DataFrame:
    """Failed rows per failure label."""
    return extraction_failures(df, genre).groupBy(genre).agg(F.count("*").alias("n"))


def genre_fallback(
    df: DataFrame,
    page_rows: DataFrame,
    url: str = "url",
    marker: str = fixed.GENRE_MARK,
    raw: str = "genre_raw",
    genre: str = "genre",
) -> DataFrame:
    """Look undetected genres up on the page that the raw text cites.

    ``page_rows`` holds the row texts ``(url, pos, text)`` of the pages that could be read. A row
    that mentions "wiki" and has no genre takes the page's ``marker`` rows, stripped and joined; it
    keeps its label if the page has none, and gets the missing-page label if there is no page.
    """
    stripped = F.regexp_replace(F.replace("text", F.lit("\n"), F.lit("")), f"^.*{marker}s*", "")
    hit = F.when(F.col("text").contains(marker), F.struct("pos", stripped.alias("text")))
    found = page_rows.groupBy(F.col(url).alias("_url")).agg(
        F.array_sort(F.collect_list(hit)).alias("_hits"), F.lit(True).alias("_read")
    )
    found = found.select("_url", "_read", F.when(F.size("_hits") > 0, F.array_join("_hits.text", " ")).alias("_found"))
    is_open = F.coalesce(F.col(raw).contains(fixed.CITES_PAGE) & (F.col(genre) == fixed.NO_GENRE), F.lit(False))
    cited = F.regexp_replace(F.col(raw), fixed.AROUND_ADDRESS, "")
    looked_up = F.when(F.col("_read"), F.coalesce("_found", F.col(genre))).otherwise(fixed.PAGE_MISSING)
    # Settled rows take no part in the join, where they would all share one null key.
    asked = join_totals(df.filter(is_open).withColumn("_url", cited), found, ["_url"], "left")
    asked = asked.withColumn(genre, looked_up).select(*df.columns)
    return df.filter(~is_open).unionByName(asked)


def genre_flags(df: DataFrame, genre: str = "genre", rules=fixed.GENRE_RULES) -> DataFrame:
    """Add one 0/1 column per rule. Needles match inside words; a null genre sets no flag."""
    source = F.col(genre)
    flags = {}
    for name, pattern, written, needle in rules:
        text = source if pattern is None else F.regexp_replace(source, pattern, written)
        flags[name] = F.coalesce(text.rlike(needle), F.lit(False)).cast("int")
    return df.withColumns(flags)


def add_others(df: DataFrame, flags: list[str], out: str = "others") -> DataFrame:
    """1 where no flag is set."""
    return df.withColumn(out, (reduce(add, [F.col(c) for c in flags]) <= 0).cast("int"))


def select_range(df: DataFrame, first: str, last: str) -> list[str]:
    """The column names from ``first`` to ``last``."""
    return df.columns[df.columns.index(first) : df.columns.index(last) + 1]


def filter_flag(df: DataFrame, name: str) -> DataFrame:
    """Rows whose flag is 1."""
    return df.filter(F.col(name) == 1)


def genre_long(df: DataFrame, flags: list[str], out: str = "genre_tidy") -> DataFrame:
    """One row per document and genre whose flag is 1; the flags go."""
    names = F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in flags])
    others = [c for c in df.columns if c not in flags]
    return df.select(*others, F.explode(F.array_compact(names)).alias(out))
