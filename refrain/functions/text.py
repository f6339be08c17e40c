"""Row-local text expressions: cleaning, tokens, keys and buckets. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain import fixed

# A word is a run of letters and digits; apostrophes inside it belong to it.
TOKEN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"
WORD_CHAR = r"[\p{L}\p{N}]"
NON_ALNUM = r"[^\p{L}\p{N}]+"


def replace_chain(col: Column, steps: Iterable[tuple[str, str]]) -> Column:
    """Apply regex replacements in order, each on the output of the one before."""
    for pattern, replacement in steps:
        col = F.regexp_replace(col, pattern, replacement)
    return col


def tokens(col: Column) -> Column:
    """Lower-case words of a text as ``array<string>``, in text order."""
    return F.regexp_extract_all(F.lower(F.replace(col, F.lit("’"), F.lit("'"))), F.lit(TOKEN), 0)


def clean_scraped(col: Column) -> Column:
    """Newlines become spaces, carriage returns and double quotes go, outer whitespace is cut."""
    return F.regexp_replace(F.translate(col, '\n\r"', " "), r"^\s+|\s+$", "")


def dash_key(col: Column) -> Column:
    """A title as a search key: no commas or ampersands, dashes for spaces."""
    bare = F.translate(F.replace(col, F.lit('"'), F.lit("")), ",&", "")
    return F.translate(F.replace(bare, F.lit("  "), F.lit(" ")), " ", "-")


def genre_search_url(title: Column, artist: Column) -> Column:
    """The address whose text is searched for a song's genre: both names as search keys, in lower case."""
    return request_url(fixed.GENRE_SEARCH_URL, F.lower(dash_key(title)), F.lower(dash_key(artist)))


def decade(year: Column) -> Column:
    """The decade label of a year; years outside every range take the fallback label."""
    label = F.lit(fixed.DECADE_ELSE)
    for name, first, last in reversed(fixed.DECADES):
        label = F.when(year.between(first, last), name).otherwise(label)
    return label


def strip_to_key(col: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.lower(F.regexp_replace(col, NON_ALNUM, ""))


def normalise(col: Column) -> Column:
    """Drop punctuation and symbols, lower-case, and squeeze whitespace, in that order."""
    return F.regexp_replace(F.lower(F.regexp_replace(col, r"[\p{P}\p{S}]+", "")), r"\s+", " ")


def words_of(col: Column, min_len: int = 1) -> Column:
    """Blank-separated words of a normalised text that have at least ``min_len`` characters."""
    return F.filter(F.split(col, " "), lambda w: F.length(w) >= min_len)


def request_url(template: str, *parts: Column) -> Column:
    """Fill a ``%s`` / ``%d`` address template from columns."""
    return F.format_string(template, *parts)
