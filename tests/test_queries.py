"""Every registered query against its SQL twin, row for row."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import canon
from refrain.operators import models
from refrain.plans import topics as topic_plans
from workload.oracle import ORACLE
from workload.queries import QUERIES

# Keys of the inventory that have no SQL twin.
ROWS_ONLY = {
    "svm_count", "svm_binary", "svm_embedding", "svm_sumvec", "logit_count",
    "repeated_cv", "lda_topics", "lda_topics_subset", "lda_beta", "lda_gamma",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, small, name):
    got = QUERIES[name](spark, small).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_only_the_expected_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 25


@pytest.mark.parametrize("name", ["tfidf_by_decade", "cooccurrence", "rank_tie_fill", "train_test_split", "dense_index"])
def test_partition_count_does_not_matter(spark, small, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "4", "32"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(canon(QUERIES[name](spark, small).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_topic_weights_are_of_the_whole_corpus_model(spark, small, monkeypatch):
    """Weights come from the model of 20 topics over all terms of two or more letters; one pass is enough to see it."""
    fitted = topic_plans.topic_model
    monkeypatch.setattr(topic_plans, "topic_model", lambda *a, **more: fitted(*a, **more | {"max_iter": 1}))
    beta = QUERIES["lda_beta"](spark, small)
    assert beta.select("topic").distinct().count() == 20 and beta.filter("length(term) = 2").count() > 0
    gamma = QUERIES["lda_gamma"](spark, small)
    assert gamma.select("topic").distinct().count() == 20


def test_cross_validation_is_of_the_scaled_svm_on_counts(spark, small, monkeypatch):
    """Ten folds, three repeats, one feature a word."""
    seen = []
    monkeypatch.setattr(models, "repeated_cv", lambda estimator, df, folds, repeats, seed: seen.append((estimator, df, folds, repeats)))
    QUERIES["repeated_cv"](spark, small)
    (estimator, df, folds, repeats), = seen
    assert [type(s).__name__ for s in estimator.getStages()] == ["StandardScaler", "LinearSVC"]
    assert (folds, repeats) == (10, 3) and df.first()["features"].size > 100
