"""Canonical title and artist keys, built from ordered alias tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import request_url, strip_to_key

Aliases = list[tuple[str, str]]


def apply_aliases(col: Column, aliases: Aliases, mode: str) -> Column:
    """Fold the aliases over ``col``: a later alias sees what an earlier one wrote.

    ``mode="regex"`` reads each alias as a pattern, so one with brackets matches the text without
    them; ``mode="literal"`` reads it as plain text. A pattern without special characters means the
    same in both, and is then replaced as plain text.
    """
    if mode not in ("regex", "literal"):
        raise ValueError(f"mode must be 'regex' or 'literal', not {mode!r}")
    for pattern, replacement in aliases:
        if mode == "regex" and re.search(r"[\\.^$|?*+()\[\]{}]", pattern):
            col = F.regexp_replace(col, pattern, replacement)
        else:
            col = F.replace(col, F.lit(pattern), F.lit(replacement))
    return col


def canon_title(col: Column, aliases: Aliases = fixed.TITLE_ALIASES, mode: str = "literal") -> Column:
    """Title key: aliases, then letters and digits only, lower case."""
    return strip_to_key(apply_aliases(col, aliases, mode))


def with_artist_key(
    df: DataFrame,
    artist: str,
    out: str,
    aliases: Aliases = fixed.ARTIST_ALIASES,
    mode: str = "literal",
) -> DataFrame:
    """Add the artist key: aliases, then the first branch that applies, then a last strip.

    The aliased name is a column of its own because every branch reads it.
    """
    name = F.col("_aliased")
    branches = list(fixed.ARTIST_BRANCHES)
    if mode == "literal":
        branches[-1] = fixed.ARTIST_PLUS_LITERAL
    key = F.lower(name)
    for test, cut in reversed(branches):
        key = F.when(name.rlike(test), strip_to_key(F.regexp_replace(name, cut, ""))).otherwise(key)
    return (
        df.withColumn("_aliased", apply_aliases(F.col(artist), aliases, mode))
        .withColumn(out, F.translate(key, fixed.ARTIST_STRIP, ""))
        .drop("_aliased")
    )


def alias_matcher(aliases: Aliases, mode: str = "literal") -> str:
    """One pattern that finds any of the aliases."""
    quoted = [p if mode == "regex" else re.sub(r"([^\w\s])", r"\\\1", p) for p, _ in aliases]
    return "|".join(f"(?:{p})" for p in dict.fromkeys(quoted))


def with_name_keys(
    df: DataFrame, title: str, artist: str, title_key: str = "title_key", artist_key: str = "artist_key", mode: str = "literal"
) -> DataFrame:
    """Add both keys, made once per distinct name.

    One matcher over all aliases decides which names hold any; only those go through the ordered replacements. The keys
    are joined back by a computed name, so that a name with many rows can be split. A null name has a null key.
    """
    for name, aliases, out in ((title, fixed.TITLE_ALIASES, title_key), (artist, fixed.ARTIST_ALIASES, artist_key)):
        names = df.select(F.col(name).alias("_name")).filter("_name is not null").distinct()
        held = F.col("_name").rlike(alias_matcher(aliases, mode))
        names = names.withColumn("_folded", F.when(held, apply_aliases(F.col("_name"), aliases, mode)).otherwise(F.col("_name")))
        if out == title_key:
            keyed = names.withColumn(out, strip_to_key(F.col("_folded")))
        else:
            keyed = with_artist_key(names, "_folded", out, aliases=[], mode=mode)
        keyed = keyed.select(F.concat("_name", F.lit("")).alias("_name"), out)
        df = df.withColumn("_name", F.concat(F.col(name), F.lit(""))).join(keyed, "_name", "left").drop("_name")
    return df


def with_lyric_url(df: DataFrame, title: str, artist: str, out: str = "lyrics_url", mode: str = "literal") -> DataFrame:
    """Add the lyric page address made of the artist key and the title key."""
    keyed = with_artist_key(df, artist, "_artist_key", mode=mode)
    url = request_url(fixed.LYRIC_URL, F.col("_artist_key"), canon_title(F.col(title), mode=mode))
    return keyed.withColumn(out, url).drop("_artist_key")
