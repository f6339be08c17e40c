"""Finished topic runs on the whole corpus and on parts of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.operators.documents import doc_term, document_terms, normalise_corpus
from refrain.operators.topics import top_terms, topic_model, topic_terms
from refrain.session import pin


def corpus_topics(songs: DataFrame, stop: list[str], k: int = fixed.TOPICS_ALL, min_share: float = 0.0, **how):
    """Topics of all songs over terms of two or more characters: model, term index, vectors."""
    terms = normalise_corpus(songs.select("lyrics_id", "lyrics"), "lyrics", stop, min_len=2)
    counts = document_terms(terms, "terms", "lyrics_id")
    n_docs = songs.agg(F.count("*")).scalar() if min_share > 0 else None
    return topic_model(counts, "lyrics_id", k, n_docs=n_docs, min_share=min_share, **how)


def subset_topics(songs: DataFrame, stop: list[str], k: int = fixed.TOPICS_SUBSET, **how):
    """Topics of some songs over terms of three or more characters within the frequency bounds."""
    # Texts are stemmed once: the terms are read for the bounds and the counts, the counts for the index and the vectors.
    terms = pin(normalise_corpus(songs.select("lyrics_id", "lyrics"), "lyrics", stop, min_len=3))
    counts = pin(doc_term(terms, "terms", "lyrics_id"))
    return topic_model(counts, "lyrics_id", k, **how)


def top_terms_of_subsets(parts: dict[str, DataFrame], stop: list[str], top: int = 10) -> DataFrame:
    """The heaviest terms per topic of several parts of the corpus, stacked under ``subset``."""
    reports = []
    for name, songs in parts.items():
        model, index, _ = subset_topics(songs, stop)
        reports.append(top_terms(topic_terms(model, index), top).withColumn("subset", F.lit(name)))
    return reduce(DataFrame.unionByName, reports)
