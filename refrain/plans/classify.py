"""Finished classifier runs: one binary label, four feature sets, two linear models."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.operators.features import counted_words, embedding_sum_feature, embedding_values, scalar_vectors, word_vectors
from refrain.operators.models import confusion_matrix
from refrain.operators.sampling import class_balance, mark_train
from refrain.operators.words import explode_words, text_words
from refrain.session import pin, training_set

FEATURES = ("count", "binary", "embedding", "sumvec")


def labelled_words(songs: DataFrame, flag: str, stop: list[str], seed: int, key: str = "lyrics_id") -> DataFrame:
    """Balanced songs with their label and non-stop words: ``(key, label, words)``.

    The sample is written once, since its vocabulary, vectors and split all read it again.
    """
    balanced = class_balance(songs.select(key, flag, "lyrics"), flag, key, seed)
    return pin(balanced.select(key, "label", text_words("lyrics", stop).alias("words")))


def feature_values(
    labelled: DataFrame, kind: str, dictionary: DataFrame | None = None
) -> DataFrame:
    """The features in long form, ``(key, label, word, value)``: counts, 1, or the word's vector sum."""
    long = counted_words(labelled, "words", binary=kind != "count")
    return embedding_values(long, dictionary) if kind == "embedding" else long


def with_features(
    labelled: DataFrame, kind: str, dictionary: DataFrame | None = None, key: str = "lyrics_id",
    min_share: float = fixed.MIN_DOC_SHARE,
) -> DataFrame:
    """``(key, label, features)`` of one kind: count, binary, embedding or sumvec.

    Words in fewer than ``min_share`` of the documents have no place in the vectors.
    """
    if kind in ("count", "binary", "embedding"):
        # Counted and written first, so that no later plan carries the joins and subqueries of the features.
        long = feature_values(labelled, kind, dictionary)
        n_docs = F.lit(labelled.count())
        return word_vectors(pin(long) if kind == "embedding" else long, [key, "label"], n_docs, min_share)[0]
    if kind == "sumvec":
        tok = labelled.select(key, "label", explode_words("words", "word"))
        return scalar_vectors(embedding_sum_feature(tok, dictionary, [key, "label"]), ["sum_vec"])
    raise ValueError(f"kind must be one of {FEATURES}, not {kind!r}")


def predict_held_out(
    featured: DataFrame, estimator: Estimator, frac: float = fixed.TRAIN_SHARE, seed: int = fixed.SPLIT_SEED,
    key: str = "lyrics_id",
) -> DataFrame:
    """Fit on an exact seeded share of the rows of each label and predict the others.

    The order of the split differs from the one the balanced sample was drawn in, though the seeds may be equal.
    """
    pinned = training_set(featured)
    marked = mark_train(pinned, key, frac, f"{seed}-split", stratum="label")
    model = estimator.fit(marked.filter("is_train"))
    return model.transform(marked.filter("NOT is_train")).select(key, "label", "prediction")


def evaluate(featured: DataFrame, estimator: Estimator, **split) -> DataFrame:
    """The confusion matrix of the held-out rows."""
    return confusion_matrix(predict_held_out(featured, estimator, **split))
