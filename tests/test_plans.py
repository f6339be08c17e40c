"""What the plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from workload.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_join_anywhere(spark, small):
    for name in ("tfidf_by_song", "tfidf_by_decade", "sentiment_density", "class_balance", "train_test_split", "dtm_summary"):
        text = plan(QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_word_count_reads_one_column_and_shuffles_counts_only(spark, small):
    text = plan(QUERIES["word_freq"](spark, small))
    assert "ReadSchema: struct<text:string>" in text and "TakeOrderedAndProject" in text
    assert text.count("regexp_extract_all") == 1 and text.count("Exchange hashpartitioning") == 1


def test_sentiment_needs_one_shuffle_of_one_row_per_song(spark, small):
    text = plan(QUERIES["sentiment_normalised"](spark, small))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning(lyrics_id") == 1


def test_richness_is_row_local(spark, small):
    text = plan(QUERIES["lexical_richness"](spark, small))
    assert "hashpartitioning" not in text and text.count("regexp_extract_all") == 1


def test_top_k_is_cut_before_the_shuffle(spark, small):
    assert plan(QUERIES["tfidf_by_song"](spark, small)).count("WindowGroupLimit") == 2


def test_python_only_where_it_must_be(spark, small):
    for name in ("genre_pipeline", "canon_artist", "cooccurrence", "rake_keywords", "doc_term_bounds"):
        text = plan(QUERIES[name](spark, small))
        assert "Python" not in text and "Arrow" not in text, name


def test_frequent_term_is_split(spark):
    """A term in every document is joined by several tasks once its partition counts as skewed."""
    from refrain.operators.tfidf import tf_idf

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("g"), F.lit(4).alias("len"))
        hot = ids.withColumn("w", F.lit("the"))
        cold = ids.withColumn("w", F.concat(F.lit("w"), F.col("g") % 5000))
        counts = hot.unionByName(cold).withColumn("n", F.lit(1).cast("bigint"))
        weighed = tf_idf(counts, "w", "g", "n", total="len", n_groups=F.lit(60_000)).select("w", "tf_idf")
        assert weighed.filter("w = 'the'").count() == 60_000
        rows = weighed.collect()
        assert len(rows) == 120_000
        final = weighed
        final.write.format("noop").mode("overwrite").save()
        final._jdf.queryExecution().executedPlan().execute().count()
        assert "skew=true" in final._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["word_freq", "tfidf_by_song"])
def test_spread_uses_every_core_on_one_file(spark, small, name):
    assert "RoundRobinPartitioning" in plan(QUERIES[name](spark, small))
