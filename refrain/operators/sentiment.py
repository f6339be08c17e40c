"""Lexicon sentiment per document and per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators.sizing import broadcast_if_small
from refrain.operators.words import unnest_tokens


def pivot_counts(df: DataFrame, keys: list[str], label: str, labels: list[str]) -> DataFrame:
    """One column per known label with its number of rows, null where there is none."""
    hits = [F.sum(F.when(F.col(label) == name, F.lit(1).cast("bigint"))).alias(name) for name in labels]
    return df.groupBy(*keys).agg(*hits)


def sentiment_net(
    tok: DataFrame, lexicon: DataFrame, key: str = "lyrics_id", word: str = "word", fill: int | None = None
) -> DataFrame:
    """Positive, negative and net word counts per document under a two-label lexicon.

    A document with one polarity only has a null net sentiment unless ``fill`` is given; one without
    a lexicon word is absent.
    """
    hits = tok.join(broadcast_if_small(lexicon), word)
    counts = pivot_counts(hits, [key], "sentiment", ["negative", "positive"])
    if fill is not None:
        counts = counts.fillna(fill, ["negative", "positive"])
    return counts.withColumn("sentiment", F.col("positive") - F.col("negative"))


def sentiment_score(
    tok: DataFrame,
    lexicon: DataFrame,
    key: str = "lyrics_id",
    word: str = "word",
    length: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Sum of word scores per document; with ``length``, also that sum per word of the document.

    ``length`` names a column of ``tok`` that holds the document's word count, ``keep`` further
    columns that are constant within a document. They ride along as grouping columns, so attributes
    need no join afterwards.
    """
    keys = [key, *(keep or []), *([length] if length else [])]
    hits = tok.join(broadcast_if_small(lexicon), word)
    scored = hits.groupBy(*keys).agg(F.sum("score").cast("bigint").alias("sentiment"))
    if length:
        scored = scored.withColumn(
            "ave_sentiment", F.col("sentiment").cast("double") / F.col(length).cast("double")
        )
    return scored


def song_sentiment(
    songs: DataFrame, lexicon: DataFrame, keep: list[str], key: str = "lyrics_id", text: str = "lyrics"
) -> DataFrame:
    """Length-normalised sentiment per song with the song's attributes ``keep`` beside it."""
    tok = unnest_tokens(songs.select(key, *keep, text), "word", text, length="lyrics_length")
    return sentiment_score(tok, lexicon, key, length="lyrics_length", keep=keep)


def sentiment_relative(
    counts: DataFrame, lexicon: DataFrame, group: str, word: str = "word", n: str = "n"
) -> DataFrame:
    """Words per emotion as a part of all words of the group; a word may carry several emotions."""
    totals = counts.groupBy(group).agg(F.sum(n).cast("bigint").alias("n_group"))
    hits = counts.join(broadcast_if_small(lexicon), word)
    return (
        hits.groupBy(group, "sentiment")
        .agg(F.sum(n).cast("bigint").alias("total"))
        .join(totals, group)
        .withColumn("relative_sentiment", F.col("total").cast("double") / F.col("n_group").cast("double"))
    )
