"""Corpus normalisation and the sparse document-term table ``(doc, term, n)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.stemming import stem, stem_array
from refrain.functions.text import normalise, words_of
from refrain.operators.sizing import broadcast_if_small
from refrain.operators.words import document_counts
from refrain.session import pin


def normalise_corpus(
    df: DataFrame,
    col: str,
    stop: list[str],
    out: str = "terms",
    stemmed: bool = True,
    stop_before_stem: bool = False,
    min_len: int = 1,
) -> DataFrame:
    """Replace a text by its normalised terms: punctuation, case, whitespace, stems, stop words.

    Stop words go after stemming, so those the stemmer alters stay, unless ``stop_before_stem``.
    """
    def keep(words: Column) -> Column:
        return F.filter(words, lambda w: ~w.isin(stop) & (F.length(w) >= min_len))

    others = [c for c in df.columns if c != col]
    terms = words_of(normalise(F.col(col)), 1)
    if stop_before_stem:
        terms = F.filter(terms, lambda w: ~w.isin(stop))
    if stemmed:
        terms = stem_array(terms)
    return df.select(*others, keep(terms).alias(out))


def stem_tokens(tok: DataFrame, col: str = "word", out: str = "stem") -> DataFrame:
    """Add the stem of each word; row-local, and each distinct word of a batch is stemmed once."""
    return tok.withColumn(out, stem(F.col(col)))


def document_terms(df: DataFrame, terms: str, key: str) -> DataFrame:
    """The unbounded document-term table of rows that hold one document's term array each."""
    return document_counts(df.select(key, terms), terms, word="term")


def bounded_vocabulary(dt: DataFrame, n_docs: Column, min_share: float, max_share: float) -> DataFrame:
    """Terms whose document frequency lies within the bounds: ``(term, df)``."""
    low, high = F.lit(float(min_share)) * n_docs, F.lit(float(max_share)) * n_docs
    terms = dt.groupBy("term").agg(F.count("*").alias("df"))
    return terms.filter((F.col("df") >= low) & (F.col("df") <= high))


def doc_term(
    df: DataFrame,
    terms: str,
    key: str,
    min_share: float = fixed.MIN_DOC_SHARE,
    max_share: float = fixed.MAX_DOC_SHARE,
) -> DataFrame:
    """Document-term counts of the terms within the document-frequency bounds.

    Documents without such a term have no row, so the empty ones are gone. With ``min_share`` s at
    most (mean distinct terms per document) / s terms survive. Their list is written once to the
    checkpoint folder and broadcast if its size allows; then the counts are never shuffled.
    """
    dt = document_terms(df, terms, key)
    n_docs = df.agg(F.count("*")).scalar()
    vocabulary = pin(bounded_vocabulary(dt, n_docs, min_share, max_share).select("term"))
    return dt.join(broadcast_if_small(vocabulary), "term", "left_semi")


def nonempty_docs(df: DataFrame, dt: DataFrame, key: str) -> DataFrame:
    """The documents that keep at least one term."""
    return df.join(dt.select(key).distinct(), key, "left_semi")


def dtm_summary(dt: DataFrame, n_docs: Column) -> DataFrame:
    """Documents, terms, filled cells and the empty part of the matrix, from one count per term."""
    per_term = dt.groupBy("term").agg(F.count("*").alias("df"))
    sizes = per_term.agg(F.count("*").alias("terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("non_zero"))
    cells = n_docs.cast("double") * F.col("terms")
    return sizes.select(
        n_docs.alias("docs"), "terms", "non_zero", (1 - F.col("non_zero") / cells).alias("sparsity")
    )
