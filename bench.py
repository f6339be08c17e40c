"""Time the headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from refrain.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "word_freq", "word_freq_by_decade", "wordcloud_freq", "tfidf_by_song", "tfidf_by_decade", "tfidf_by_genre",
    "tfidf_by_singer", "lexical_richness", "richness_by_genre_decade", "sentiment_bing", "sentiment_normalised",
    "mean_sentiment_by_genre", "sentiment_nrc", "sentiment_density", "extreme_sentiment", "top_nouns_by_decade",
    "top_adj_by_genre", "dependency_pairs", "cooccurrence", "rake_keywords", "doc_term_bounds", "dtm_summary",
    "top_terms", "genre_pipeline", "chart_clean", "rank_tie_fill", "canon_artist", "lyrics_fill", "dense_index",
    "train_test_split", "class_balance", "features_count", "features_embedding", "stem_tokens",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["word_freq"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
