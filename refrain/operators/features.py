"""Document features for classification: long form for SQL, sparse vectors for Spark ML.

A linear model keeps one weight per word. ``min_share``, a share of the documents, bounds the words at (mean distinct
words of a document) / ``min_share`` on any corpus; the words themselves stay in a table.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.operators.sizing import broadcast_if_small
from refrain.operators.vocabulary import sparse_vectors, word_index
from refrain.operators.words import document_counts


def count_features(tok: DataFrame, key: list[str], word: str = "word") -> DataFrame:
    """Occurrences per document key and word."""
    return tok.groupBy(*key, word).agg(F.count("*").alias("n"))


def binary_features(tok: DataFrame, key: list[str], word: str = "word") -> DataFrame:
    """1 per document key and word that occurs in it."""
    return tok.select(*key, word).distinct().withColumn("present", F.lit(1))


def embedding_dict(vectors: DataFrame, word: str = "word", vec: str = "embedding") -> DataFrame:
    """Each word with the sum of its vector: ``(word, vec_sum)``."""
    total = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return vectors.select(word, total.alias("vec_sum"))


def embedding_features(tok: DataFrame, dictionary: DataFrame, key: list[str], word: str = "word") -> DataFrame:
    """The vector sum of each distinct word of a document that the dictionary knows."""
    known = tok.join(broadcast_if_small(dictionary), word)
    return known.select(*key, word, F.col("vec_sum").alias("value")).distinct()


def embedding_sum_feature(tok: DataFrame, dictionary: DataFrame, key: list[str]) -> DataFrame:
    """One number per document: its distinct words' vector sums added up."""
    return embedding_features(tok, dictionary, key).groupBy(*key).agg(F.sum("value").alias("sum_vec"))


def counted_words(df: DataFrame, words: str, binary: bool = False) -> DataFrame:
    """``(…, word, value)`` of rows that hold one document's words each: occurrences, or 1. Nothing is shuffled."""
    counts = document_counts(df, words)
    value = F.lit(1.0) if binary else F.col("n").cast("double")
    return counts.withColumn("value", value).drop("n")


def word_vectors(
    long: DataFrame, key: list[str], n_docs: Column | None = None, min_share: float = 0.0, out: str = "features"
) -> tuple[DataFrame, DataFrame]:
    """Sparse vectors of ``(key, word, value)`` rows and the word index they are built on."""
    index = word_index(long, n_docs, min_share)
    return sparse_vectors(long, index, key, "value", out=out), index


def embedding_values(long: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The rows whose word the dictionary knows, with the word's vector sum as ``value``."""
    return long.drop("value").join(dictionary.select("word", F.col("vec_sum").alias("value")), "word")


def scalar_vectors(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Plain numeric columns as a vector."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)
