"""Literal cases, properties and skew cases of the operators."""

from __future__ import annotations

import inspect
import math
import os
import random
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from refrain import fixed
from refrain.operators import annotate, distribution, documents, features, joins, models, ranking, richness
from refrain.operators import sampling, sentiment, sizing, topics, vocabulary, words
from refrain.operators.ordered import add_index, fill_ties, with_previous
from refrain.operators.tfidf import tf_idf
from refrain.plans import classify, fill, sentiment as sentiment_plans, topics as topic_plans, words as word_plans
from refrain.sources.tables import collect_by_key, read_annotated, read_table, write_table


def test_counts_inside_the_row(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["z"])]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    got = sorted((r["id"], r["word"], r["n"]) for r in words.document_counts(df, "w").collect())
    assert got == [(1, "a", 1), (1, "b", 2), (4, "z", 1)]


def test_counts_agree_with_a_group_by(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice("abcdefgh") for _ in range(rng.randrange(50))]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    inside = {(r["id"], r["word"]): r["n"] for r in words.document_counts(df, "w").collect()}
    assert inside == {(i, w): n for i, ws in rows for w, n in Counter(ws).items()}


def test_unnest_keeps_positions_and_length(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "id int, t string")
    got = words.unnest_tokens(df, "word", "t", keep_pos=True, length="len").collect()
    assert [(r["id"], r["pos"], r["word"], r["len"]) for r in got] == [(1, 0, "b", 3), (1, 1, "a", 3), (1, 2, "b", 3)]


def test_stop_words_as_list_and_table(spark):
    tok = spark.createDataFrame([("the",), ("sun",), ("a",)], "word string")
    stop = spark.createDataFrame([("the",), ("a",)], "word string")
    assert [r[0] for r in words.remove_stopwords(tok, ["the", "a"]).collect()] == ["sun"]
    assert [r[0] for r in words.remove_stopwords(tok, stop).collect()] == ["sun"]
    assert [r[0] for r in words.drop_words(tok, ["sun"]).orderBy("word").collect()] == ["a", "the"]


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(10)
    assert "ResolvedHint" in sizing.broadcast_if_small(df, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in sizing.broadcast_if_small(df, 9)._jdf.queryExecution().analyzed().toString()


def test_natural_join(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "p")], "k int, w string")
    assert sizing.natural_join(a, b).collect()[0] == (1, "x", "p")
    with pytest.raises(ValueError):
        sizing.natural_join(a, b.select("w"))


def test_topk_with_ties_and_indexes(spark):
    rows = [("g", "a", 3), ("g", "b", 2), ("g", "c", 2), ("h", "d", 1)]
    df = spark.createDataFrame(rows, "g string, w string, n int")
    cut = ranking.topk(df, ["g"], "n", 2, ["w"], index="reverse").orderBy("x").collect()
    assert [(r["w"], r["x"]) for r in cut] == [("d", 1), ("b", 2), ("a", 3)]
    tied = ranking.topk(df, ["g"], "n", 2, ["w"], ties=True, index="asc").orderBy("g", "order").collect()
    assert [(r["w"], r["order"]) for r in tied] == [("c", 1), ("b", 2), ("a", 3), ("d", 1)]


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("x", 1), ("x", 3), ("y", 5)], "g string, n int")
    sums = ranking.share_of(df, "n", ["g"]).groupBy("g").agg(F.sum("perc").alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0) for r in sums)


@pytest.mark.parametrize("max_groups", [None, 3])
def test_tf_idf_properties(spark, max_groups):
    rows = [("a", "x", 3), ("a", "y", 1), ("b", "x", 2), ("c", "x", 1), ("c", "z", 1)]
    counts = spark.createDataFrame(rows, "g string, w string, n bigint")
    got = tf_idf(counts, "w", "g", "n", max_groups=max_groups).collect()
    assert len(got) == len(rows)
    for group in "abc":
        assert math.isclose(sum(r["tf"] for r in got if r["g"] == group), 1.0)
    by_key = {(r["g"], r["w"]): r for r in got}
    assert by_key["a", "x"]["idf"] == 0.0
    assert math.isclose(by_key["a", "y"]["tf_idf"], 0.25 * math.log(3))


def test_chosen_songs(spark):
    songs = spark.createDataFrame(
        [(i, 1970, f"song {i}", f"word{i} word{i} common other{i}") for i in range(4)],
        "lyrics_id int, year int, song_name string, lyrics string",
    )
    top = word_plans.tf_idf_by_song(songs, k=2)
    got = word_plans.chosen_songs(top, [1, 3]).orderBy("x").collect()
    assert [(r["lyrics_id"], r["word"]) for r in got] == [(3, "other3"), (3, "word3"), (1, "other1"), (1, "word1")]


def ranks(spark, values):
    return spark.createDataFrame([(1970, i, v) for i, v in enumerate(values)], "year int, pos int, rank string")


@pytest.mark.parametrize(
    "fill, want", [("prev", [None, 1, 1, None, 4, 4]), ("run", [None, 1, 1, 1, 4, 4])]
)
def test_consecutive_ties(spark, fill, want):
    df = ranks(spark, ["Tie", "1", "Tie", "Tie", "4", "Tie"])
    for block in (None, F.floor(F.col("pos") / 2), F.col("pos")):
        got = fill_ties(df, ["year"], ["pos"], "rank", fill, block=block).orderBy("pos").collect()
        assert [r["rank"] for r in got] == want


def test_previous_row_across_blocks(spark):
    rng = random.Random(2)
    rows, expected = [], {}
    for part in range(3):
        places = sorted(rng.sample(range(1000), 200))
        for before, here in zip([None, *places], places):
            rows.append((part, here, f"v{here}"))
            expected[part, here] = None if before is None else f"v{before}"
    df = spark.createDataFrame(rows, "p int, pos int, v string")
    for span in (1, 7, 10_000):
        out = with_previous(df, ["p"], ["pos"], F.col("v"), "prev", F.floor(F.col("pos") / span))
        assert {(r["p"], r["pos"]): r["prev"] for r in out.collect()} == expected


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    got = add_index(df, ["k"], "i").orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(1, 1001))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)


@pytest.mark.parametrize("n, frac", [(1, 0.75), (7, 0.75), (1000, 0.75), (1000, 0.0), (1000, 1.0)])
def test_split_is_exact_disjoint_and_complete(spark, n, frac):
    train, test = sampling.train_test_split(spark.range(n), "id", frac, 5)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert (len(a), a & b, len(a | b)) == (math.floor(frac * n), set(), n)


def test_split_depends_on_the_seed_only(spark):
    def chosen(seed, parts):
        return {r[0] for r in sampling.train_test_split(spark.range(0, 200, 1, parts), "id", 0.5, seed)[0].collect()}

    assert chosen(1, 2) == chosen(1, 7) != chosen(2, 2)
    approx = sampling.mark_train_approx(spark.range(4000), "id", 0.75, 1).filter("is_train").count()
    assert 2850 < approx < 3150


def test_class_balance(spark):
    df = spark.range(100).withColumn("flag", (F.col("id") % 5 == 0).cast("int"))
    got = Counter(r["label"] for r in sampling.class_balance(df, "flag", "id", 3).collect())
    assert got == {1.0: 20, 0.0: 20}
    few = df.withColumn("flag", 1 - F.col("flag"))
    assert Counter(r["label"] for r in sampling.class_balance(few, "flag", "id", 3).collect()) == {1.0: 80, 0.0: 20}


def test_sentiment_null_cases(spark):
    tok = spark.createDataFrame([(1, "good"), (1, "bad"), (1, "good"), (2, "good"), (3, "x")], "lyrics_id int, word string")
    bing = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "word string, sentiment string")
    got = {r["lyrics_id"]: r["sentiment"] for r in sentiment.sentiment_net(tok, bing).collect()}
    assert got == {1: 1, 2: None}
    filled = {r["lyrics_id"]: r["sentiment"] for r in sentiment.sentiment_net(tok, bing, fill=0).collect()}
    assert filled == {1: 1, 2: 1}
    emotions = spark.createDataFrame([("good", "joy"), ("good", "trust")], "word string, sentiment string")
    counts = words.word_freq(tok.withColumn("genre", F.lit("pop")), ["genre"])
    relative = {r["sentiment"]: r["relative_sentiment"] for r in sentiment.sentiment_relative(counts, emotions, "genre").collect()}
    assert relative == {"joy": 0.6, "trust": 0.6}


def test_normalised_sentiment(spark):
    songs = spark.createDataFrame([(1, 5, "good good day ok"), (2, 6, "nothing")], "lyrics_id int, rank int, lyrics string")
    lexicon = spark.createDataFrame([("good", 3)], "word string, score int")
    got = sentiment.song_sentiment(songs, lexicon, ["rank"]).collect()
    assert [(r["lyrics_id"], r["rank"], r["sentiment"], r["ave_sentiment"]) for r in got] == [(1, 5, 6, 1.5)]


def test_richness_both_ways(spark):
    songs = spark.createDataFrame([(1, "a b b the"), (2, "the"), (3, "x")], "id int, lyrics string")
    want = {1: 2 / 3, 3: 1.0}
    assert {r["id"]: r["richness"] for r in richness.song_richness(songs, ["the"]).collect()} == want
    tok = words.remove_stopwords(words.unnest_tokens(songs, "word", "lyrics"), ["the"])
    assert {r["id"]: r["richness"] for r in richness.lexical_richness(tok, "id").collect()} == want
    assert {r["id"]: r["richness"] for r in richness.lexical_richness(tok, "id", approx=True).collect()} == want


def ann(spark, sentences):
    """Tokens written as word/TAG."""
    rows = []
    for s, sentence in enumerate(sentences):
        for t, item in enumerate(sentence.split()):
            word, tag = item.split("/")
            rows.append(("doc1", 0, s, t, word, word, tag, t + 1, "nsubj" if tag == "NOUN" else "obj"))
    return spark.createDataFrame(
        rows,
        "doc_id string, paragraph_id bigint, sentence_id bigint, token_id bigint, token string, lemma string,"
        " upos string, head_token_id bigint, dep_rel string",
    )


def relevant():
    return F.col("upos").isin("NOUN", "ADJ")


def test_dependency_pairs(spark):
    df = ann(spark, ["sun/NOUN bright/ADJ", "sun/NOUN shine/VERB", "sun/NOUN bright/ADJ"])
    assert [tuple(r) for r in annotate.dependency_pairs(df).collect()] == [("bright sun", 2)]


def test_cooccurrence_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    tags = ["NOUN", "ADJ", "VERB"]
    sentences = [" ".join(f"w{rng.randrange(4)}/{rng.choice(tags)}" for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    seq = [item.split("/") for s in sentences for item in s.split()]
    for span, skipgram in ((1_000, 0), (3, 0), (3, 2)):
        monkeypatch.setattr(annotate, "SENTENCES_PER_BLOCK", span)
        want = Counter()
        for gap in range(1, skipgram + 2):
            for (a, ta), (b, tb) in zip(seq, seq[gap:]):
                if ta != "VERB" and tb != "VERB":
                    want[a, b] += 1
        got = annotate.cooccurrence(ann(spark, sentences), relevant(), skipgram).collect()
        assert {(r["term1"], r["term2"]): r["cooc"] for r in got} == want


def test_cooccurrence_counts_every_adjacent_pair(spark):
    df = ann(spark, ["a/NOUN b/NOUN c/NOUN", "d/NOUN e/NOUN"])
    assert annotate.cooccurrence(df, F.lit(True)).agg(F.sum("cooc")).first()[0] == 4


def test_cooccurrence_of_repeated_rows(spark):
    one = ann(spark, ["a/NOUN b/NOUN c/VERB", "b/NOUN a/ADJ"])
    got = annotate.cooccurrence(one.union(one), relevant()).collect()
    seq = ["a", "a", "b", "b", None, None, "b", "b", "a", "a"]
    want = Counter((x, y) for x, y in zip(seq, seq[1:]) if x and y)
    assert {(r["term1"], r["term2"]): r["cooc"] for r in got} == want


def test_keyword_runs_of_repeated_rows(spark):
    one = ann(spark, ["a/NOUN b/NOUN c/VERB d/ADJ", "e/NOUN f/NOUN"])
    twice = one.filter("sentence_id = 0").union(one)
    got = Counter(tuple(r.words) for r in annotate.keyword_runs(twice, relevant(), "token", 4).collect())
    # Token numbers less places of a, a, b, b, d, d: 0, -1, -1, -2, -1, -2.
    assert got == Counter([("a",), ("a", "b", "d"), ("b", "d"), ("e", "f")])


def test_rake_finds_runs_once(spark):
    df = annotate.rake_keywords(ann(spark, ["deep/ADJ sea/NOUN", "sea/NOUN"]), relevant(), min_freq=0)
    assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_vectors_carry_no_subquery(spark):
    labelled = spark.createDataFrame([(i, float(i % 2), ["a", "b", f"w{i % 3}"]) for i in range(12)], "lyrics_id int, label double, words array<string>")
    known = spark.createDataFrame([("a", 1.0), ("w0", 2.0), ("w1", -1.0)], "word string, vec_sum double")
    featured = classify.with_features(labelled, "embedding", known)
    plan = featured._jdf.queryExecution().optimizedPlan().toString()
    assert "subquery" not in plan.lower() and featured.count() == 12


def test_repeated_cv_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, float(i % 2), float(i % 2) + i / 100) for i in range(20)], "lyrics_id int, label double, x double")
    df = features.scalar_vectors(rows.mapInArrow(watched, rows.schema), ["x"])
    got = models.repeated_cv(models.svm_pipeline(max_iter=2), df, 2, 2, 1)
    assert got.count() == 2 and seen.value == 20


def test_rake(spark):
    df = ann(spark, ["deep/ADJ blue/ADJ sea/NOUN is/VERB blue/ADJ", "deep/ADJ sea/NOUN", "a/NOUN b/NOUN c/NOUN d/NOUN e/NOUN"])
    got = {r["keyword"]: (r["ngram"], r["freq"], r["rake"]) for r in annotate.rake_keywords(df, relevant(), min_freq=0).collect()}
    assert got["deep sea"] == (2, 1, 2.5 + 2.5)
    assert got["blue"] == (1, 1, 2.0)
    assert "a b c d e" not in got
    others = {r["keyword"]: r["rake"] for r in annotate.rake_keywords(df, relevant(), min_freq=0, degree="others").collect()}
    assert others["blue"] == 1.0


def test_word_network(spark):
    cooc = spark.createDataFrame([("a", "b", 3), ("b", "c", 2), ("x", "y", 1)], "term1 string, term2 string, cooc bigint")
    edges, nodes = annotate.word_network(cooc, 2)
    assert edges.count() == 2 and {r[0] for r in nodes.collect()} == {"a", "b", "c"}


def test_annotated_source(spark, tmp_path):
    df = ann(spark, ["sun/NOUN bright/ADJ ./PUNCT"])
    write_table(df, str(tmp_path / "ann"), partition_by=["upos"])
    back = read_annotated(spark, str(tmp_path / "ann"))
    assert back.count() == 3
    songs = spark.createDataFrame([(1, "x")], "lyrics_id bigint, song_name string")
    assert {r["song_name"] for r in annotate.prepare_annotated(back, songs).collect()} == {"x"}
    assert annotate.prepare_annotated(back, songs).count() == 2
    write_table(df.drop("lemma"), str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        read_annotated(spark, str(tmp_path / "bad"))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_tables_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    options = {"header": "false"} if fmt == "csv" else {}
    for _ in range(2):
        write_table(df, str(tmp_path / fmt), fmt=fmt)
    back = read_table(spark, str(tmp_path / fmt), fmt, schema=df.schema, **options)
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]


def test_collect_by_key(spark):
    a, b = spark.createDataFrame([(1, "x")], "r int, s string"), spark.createDataFrame([(2,)], "r int")
    got = collect_by_key({1968: a, 1969: b}, "year").orderBy("r").collect()
    assert [(r["r"], r["s"], r["year"]) for r in got] == [(1, "x", 1968), (2, None, 1969)]


def test_join_genre_drops_rows_without_genre(spark):
    key = "rank int, year int, song_name string, singer string"
    lyrics = spark.createDataFrame([(i, 1970, "s", "a", "l") for i in range(4)], key + ", lyrics string")
    rows = [(0, 1970, "s", "a", "raw", "Pop"), (1, 1970, "s", "a", "raw", fixed.PAGE_MISSING), (2, 1970, "s", "a", "raw", fixed.EXTRACTION_FAILED)]
    genres = spark.createDataFrame(rows, key + ", genre_raw string, genre string")
    assert {r["rank"]: r["genre"] for r in joins.join_genre(lyrics, genres).collect()} == {0: "Pop", 2: "raw"}


def test_lyrics_fill(spark):
    key = "rank int, year int, song_name string, singer string"
    chart = spark.createDataFrame([(1, 1970, "s", "a"), (2, 1971, "t", "a"), (3, 1972, "u", "b"), (4, 1973, "t", "a")], key)
    stored = spark.createDataFrame([(1, 1970, "s", "a", "old")] * 2, key + ", lyrics string")
    fetched = spark.createDataFrame([("t", "a", "new"), ("t", "a", "new"), ("s", "a", "other")], "song_name string, singer string, lyrics string")
    got = sorted((r["rank"], r["lyrics"]) for r in joins.lyrics_fill(chart, stored, fetched).collect())
    assert got == [(1, "old"), (2, "new"), (4, "new")]


def test_every_text_joins(spark):
    """A title with several texts gives each chart row all different ones; stored rows with other texts stay."""
    key = "rank int, year int, song_name string, singer string"
    chart = spark.createDataFrame([(1, 1970, "s", "a"), (2, 1971, "t", "a"), (2, 1971, "t", "a"), (3, 1972, None, "a")], key)
    texts = [("t", "a", "new"), ("t", "a", "new"), ("t", "a", "newer"), ("s", "a", "other"), (None, "a", "x")]
    fetched = spark.createDataFrame(texts, "song_name string, singer string, lyrics string")
    got = sorted((r["rank"], r["lyrics"]) for r in joins.join_chart_lyrics(chart, fetched, every_text=True).collect())
    assert got == [(1, "other"), (2, "new"), (2, "new"), (2, "newer"), (2, "newer")]
    stored = spark.createDataFrame([(1, 1970, "s", "a", "old"), (1, 1970, "s", "a", "old"), (1, 1970, "s", "a", "older")], key + ", lyrics string")
    got = sorted((r["rank"], r["lyrics"]) for r in joins.lyrics_fill(chart, stored, fetched, every_text=True).collect())
    assert got == [(1, "old"), (1, "older"), (2, "new"), (2, "new"), (2, "newer"), (2, "newer")]


def test_joined_rows_grow_with_the_chart(spark):
    """A title fetched many times with different texts gives each chart row one text, at any number of fetches."""
    chart = spark.range(30).selectExpr("cast(id as int) as rank", "1970 as year", "'s' as song_name", "if(id = 29, null, 'a') as singer")
    for n in (1, 10, 100):
        texts = spark.range(n).selectExpr("'s' as song_name", "'a' as singer", "concat('text ', id) as lyrics")
        assert joins.join_chart_lyrics(chart, texts).count() == 29


def test_filling_leaves_other_years_alone(spark, tmp_path):
    key = "rank int, year int, song_name string, singer string"
    path = f"{tmp_path}/store"
    rows = [(1, 1970, "s", "a", "old"), (1, 1970, "s", "a", "older"), (2, 1971, "t", "a", "old")]
    fill.start_store(spark.createDataFrame(rows, key + ", lyrics string"), path)
    files = lambda year: sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / "store" / f"year={year}").iterdir())
    before = {year: files(year) for year in (1970, 1971)}
    chart = spark.createDataFrame([(1, 1970, "s", "a"), (2, 1971, "t", "a"), (3, 1971, "u", "b"), (4, 1972, "v", "b"), (5, 1973, "w", "b")], key)
    fetched = spark.createDataFrame([("u", "b", "new"), ("u", "b", "newer"), ("v", "b", "new"), ("s", "a", "other")], "song_name string, singer string, lyrics string")
    added = {r["year"]: r["added"] for r in fill.fill_store(chart, fetched, path).collect()}
    assert added == {1971: 1, 1972: 1}
    got = sorted((r["year"], r["song_name"], r["lyrics"]) for r in read_table(spark, path).collect())
    assert got == [(1970, "s", "older"), (1971, "t", "old"), (1971, "u", "newer"), (1972, "v", "new")]
    assert files(1970) == before[1970] and files(1971) != before[1971]
    assert fill.fill_store(chart, fetched, path).count() == 0
    assert len(read_table(spark, path).collect()) == 4


def test_document_terms(spark):
    rows = [(i, "common rare%d word" % i if i else "common") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, t string")
    terms = documents.normalise_corpus(df, "t", ["word"], stemmed=False)
    dt = documents.doc_term(terms, "terms", "id", 0.2, 1.0)
    assert {(r["term"]) for r in dt.collect()} == {"common"}
    dt = documents.doc_term(terms, "terms", "id", 0.1, 0.9)
    assert dt.count() == 9 and documents.nonempty_docs(terms, dt, "id").count() == 9
    summary = documents.dtm_summary(dt, F.lit(10)).first()
    assert (summary["terms"], summary["non_zero"]) == (9, 9) and math.isclose(summary["sparsity"], 0.9)


def test_stop_words_after_or_before_stemming(spark):
    df = spark.createDataFrame([(1, "they were only singing")], "id int, t string")
    after = documents.normalise_corpus(df, "t", ["were", "only"]).first()["terms"]
    before = documents.normalise_corpus(df, "t", ["were", "only"], stop_before_stem=True).first()["terms"]
    assert (after, before) == (["they", "onli", "sing"], ["they", "sing"])


@pytest.mark.parametrize("bw", [None, 0.3, 0.02])
def test_binned_density_is_near_the_direct_sum(spark, bw):
    draw = random.Random(3)
    values = [(g, draw.gauss(0, 1 + g) if draw.random() < 0.9 else 0.25) for g in (0, 1) for _ in range(300)] + [(0, None)]
    df = spark.createDataFrame(values, "g int, v double")
    grid = [-3 + 0.25 * k for k in range(25)]
    got = {(r["g"], r["x"]): r["density"] for r in distribution.density_by_group(df, ["g"], "v", grid, bw).collect()}
    width = df.select(distribution.rule_of_thumb_bandwidth(df, "v").alias("w")).first()["w"] if bw is None else bw
    for g in (0, 1):
        own = [v for h, v in values if h == g and v is not None]
        direct = {x: sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in own) / (len(own) * width * math.sqrt(2 * math.pi)) for x in grid}
        assert all(abs(got[g, x] - direct[x]) < 1e-3 * max(direct.values()) for x in grid)


def test_direct_density_is_the_direct_sum(spark):
    draw = random.Random(7)
    values = [(g, draw.gauss(0, 1)) for g in (0, 1) for _ in range(50)] + [(0, None)]
    df = spark.createDataFrame(values, "g int, v double")
    grid, width = [-1 + 0.5 * k for k in range(5)], 0.3
    for g, x, density in distribution.density_by_group(df, ["g"], "v", grid, width, binned=False).collect():
        own = [v for h, v in values if h == g and v is not None]
        direct = sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in own) / (len(own) * width * math.sqrt(2 * math.pi))
        assert math.isclose(density, direct, rel_tol=1e-12)
    renamed = df.withColumnRenamed("v", "ave_sentiment")
    for g, x, density in sentiment_plans.sentiment_density(renamed, ["g"], grid, width, (-5.0, 5.0)).collect():
        own = [v for h, v in values if h == g and v is not None]
        direct = sum(math.exp(-(((x - v) / width) ** 2) / 2) for v in own) / (len(own) * width * math.sqrt(2 * math.pi))
        assert math.isclose(density, direct, rel_tol=1e-12)


def test_means_by_each_column(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, "x", 4.0), (2, "x", None)], "a int, b string, v double")
    got = {(r["by"], r["group"]): r["m"] for r in ranking.means_by_each(df, ["a", "b"], "v", "m").collect()}
    assert got == {("a", "1"): 3.0, ("a", "2"): None, ("b", None): 2.0, ("b", "x"): 4.0}


def test_density_integrates_to_one(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([("g", rng.gauss(0, 1)) for _ in range(200)], "g string, v double")
    grid = [-6 + 0.1 * i for i in range(121)]
    for bw in (0.3, None):
        curve = distribution.density_by_group(df, ["g"], "v", grid, bw).collect()
        assert math.isclose(sum(r["density"] for r in curve) * 0.1, 1.0, rel_tol=1e-3)
    assert distribution.clip_range(df, "v", -0.2, 0.8).count() < 200
    assert distribution.histogram_by_group(df, ["g"], "v", -1, 1, 4).agg(F.sum("n")).first()[0] == 200


def test_confusion_matrix(spark):
    rows = [(0.0, 0.0)] * 4 + [(0.0, 1.0)] + [(1.0, 1.0)] * 3 + [(1.0, 0.0)] * 2
    row = models.confusion_matrix(spark.createDataFrame(rows, "label double, prediction double")).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (4, 2, 1, 3)
    assert math.isclose(row["accuracy"], 0.7) and math.isclose(row["kappa"], 0.4)
    assert math.isclose(row["sensitivity"], 0.8) and math.isclose(row["specificity"], 0.6)


def planted(spark, n=80):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        flag = i % 2
        filler = [f"w{rng.randrange(30)}" for _ in range(10)]
        rows.append((i, flag, " ".join(filler + (["street", "flow"] if flag else ["heart"]))))
    return spark.createDataFrame(rows, "lyrics_id int, flag int, lyrics string")


@pytest.mark.parametrize("kind", classify.FEATURES)
def test_svm_finds_a_planted_signal(spark, kind):
    vectors = [(f"w{i}", [0.01 * i, 0.0]) for i in range(30)] + [("street", [5.0, 2.0]), ("heart", [-5.0, -2.0])]
    dictionary = features.embedding_dict(spark.createDataFrame(vectors, "word string, embedding array<double>"))
    labelled = classify.labelled_words(planted(spark), "flag", [], 1)
    featured = classify.with_features(labelled, kind, dictionary)
    assert classify.evaluate(featured, models.svm_pipeline(max_iter=15)).first()["accuracy"] > 0.8


def test_logit_and_repeated_cv(spark):
    labelled = classify.labelled_words(planted(spark), "flag", [], 1)
    featured = classify.with_features(labelled, "binary")
    assert classify.evaluate(featured, models.logit_pipeline(reg=0.01)).first()["accuracy"] > 0.8
    cv = models.repeated_cv(models.logit_pipeline(reg=0.01), featured, 3, 2, 7).collect()
    assert sorted(r["repeat"] for r in cv) == [1, 2] and all(r["accuracy"] > 0.8 for r in cv)


def test_embedding_weights_follow_the_dictionary(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"])], "id int, words array<string>")
    dictionary = spark.createDataFrame([("a", 2.5), ("b", -1.0)], "word string, vec_sum double")
    known = features.embedding_values(features.counted_words(df, "words", binary=True), dictionary)
    vectors, index = features.word_vectors(known, ["id"])
    assert {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()} == {1: [2.5, -1.0]}
    assert [(r["word"], r["docs"], r["place"]) for r in index.orderBy("place").collect()] == [("a", 1, 0), ("b", 1, 1)]


def test_vectors_keep_documents_whose_words_are_all_rare(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"]), (3, ["a"]), (4, []), (5, None)], "id int, words array<string>")
    long = features.counted_words(df, "words")
    vectors, index = features.word_vectors(long, ["id"], n_docs=df.agg(F.count("*")).scalar(), min_share=0.3)
    assert [r["word"] for r in index.collect()] == ["a"]
    assert {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()} == {1: [2.0], 2: [0.0], 3: [1.0]}
    entries = {r["id"]: (r["size"], r["places"], r["values"]) for r in vocabulary.vector_entries(vectors, ["id"]).collect()}
    assert entries == {1: (1, [0], [2.0]), 2: (1, [], []), 3: (1, [0], [1.0])}
    none = features.word_vectors(long.limit(0), ["id"])
    assert none[0].count() == 0 and none[1].count() == 0


def test_no_vocabulary_passes_the_driver():
    for module in (features, topics, vocabulary):
        code = inspect.getsource(module)
        assert ".collect()" not in code and ".vocabulary" not in code.replace("operators.vocabulary", "") and "createDataFrame" not in code


def test_folds_are_balanced_within_labels(spark):
    df = spark.range(1003).selectExpr("id as lyrics_id", "cast(id % 5 = 0 as double) as label")
    dealt = sampling.fold_numbers(df, "lyrics_id", "label", 10, 4).toPandas()
    assert len(dealt) == 1003 and set(dealt.fold) == set(range(10))
    for sizes in (dealt.groupby("fold").size(), dealt[dealt.label == 1].groupby("fold").size()):
        assert sizes.max() - sizes.min() <= 1


def test_strata_share_one_pass(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 7 = 0 as int) as flag", "case when id % 3 = 0 then 'a' when id % 3 = 1 then 'b' end as s")
    marked = sampling.mark_train(df, "id", 0.6, 1, stratum="s").groupBy("s").agg(F.count_if("is_train").alias("n")).collect()
    assert {r["s"]: r["n"] for r in marked} == {"a": 600, "b": 600, None: 600}
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup())
    sampling.class_balance(df, "flag", "id", 3).collect()
    assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup()) - before) <= 5
    assert sampling.mark_train(df.limit(0), "id", 0.6, 1).count() == 0
    assert sampling.class_balance(df.limit(0), "flag", "id", 1).count() == 0


def test_topic_model_is_the_variational_one(spark):
    """Two passes over a few texts equal the updates of Hoffman et al. (2010) in plain loops, on groups of any number."""
    draw = random.Random(11)
    docs = [(i + 2**60 if i else None, [f"w{draw.randrange(12)}" for _ in range(draw.randrange(1, 30))]) for i in range(25)]
    counts = documents.document_terms(spark.createDataFrame(docs, "id long, terms array<string>"), "terms", "id")
    start, index, _ = topics.topic_model(counts, "id", 3, alpha=0.5, beta=0.1, max_iter=0)
    model, _, vectors = topics.topic_model(counts, "id", 3, alpha=0.5, beta=0.1, max_iter=2)
    names = [r["term"] for r in index.orderBy("place").collect()]
    read = lambda m: np.array([r[1:] for r in sorted(m.weights.collect())])
    weights = read(start)
    psi = lambda x: (math.lgamma(x + 1e-5) - math.lgamma(x - 1e-5)) / 2e-5
    expected = lambda rows: np.exp(np.vectorize(psi)(rows) - np.vectorize(psi)(rows.sum(axis=0)))

    def mixed(words, beta):
        tally = Counter(words)
        rows, n = beta[[names.index(w) for w in tally]], np.array(list(tally.values()), dtype=float)
        gamma, change = np.ones(3), 1.0
        while change > 1e-3:
            theta = np.exp(np.vectorize(psi)(gamma) - psi(gamma.sum()))
            new = theta * (rows.T @ (n / (rows @ theta))) + 0.5
            gamma, change = new, np.abs(new - gamma).mean()
        theta = np.exp(np.vectorize(psi)(gamma) - psi(gamma.sum()))
        return gamma, list(tally), rows * theta * (n / (rows @ theta))[:, None]

    for iteration in (1, 2):
        beta, rate, added = expected(weights), (1024 + iteration) ** -0.51, np.zeros(weights.shape)
        for _, words_ in docs:
            _, terms, more = mixed(words_, beta)
            for term, row in zip(terms, more):
                added[names.index(term)] += row
        weights = (1 - rate) * weights + rate * (added + 0.1)
    assert np.allclose(read(model), weights, rtol=1e-6)
    got = {(r["id"], r["topic"]): r["gamma"] for r in topics.doc_topics(model, vectors, "id").collect()}
    for i, words_ in docs:
        gamma, _, _ = mixed(words_, expected(weights))
        assert np.allclose([got[i, t] for t in (1, 2, 3)], gamma / gamma.sum(), rtol=1e-5)


def test_slow_documents_settle_together(monkeypatch):
    """Documents that settle late are carried along: the same weights as each alone, in far fewer updates."""
    draw, calls, theta = np.random.default_rng(5), [], topics._theta
    monkeypatch.setattr(topics, "_theta", lambda gamma: calls.append(len(gamma)) or theta(gamma))
    monkeypatch.setattr(topics, "CHUNK_ENTRIES", 400)
    docs = pd.DataFrame({"places": [draw.permutation(50)[: 1 + i % 30] for i in range(300)]})
    docs["values"] = [draw.integers(1, 5, len(p)).astype(float) for p in docs["places"]]
    terms = pd.DataFrame(draw.gamma(0.3, 1.0, (50, 4)) + 0.01, columns=topics._columns(4))
    terms.insert(0, "place", range(50))

    def weights(rows):
        return {i: g for part, _, _, gamma in topics._group_steps(rows, terms, [15.0] * 4, 0.5) for i, g in zip(part.index, gamma, strict=True)}

    together = weights(docs)
    updates = len(calls)
    calls.clear()
    apart = {i: g for k in range(len(docs)) for i, g in weights(docs.iloc[[k]]).items()}
    assert sorted(together) == sorted(apart) and all(np.allclose(together[i], apart[i], rtol=1e-9) for i in apart)
    assert updates < len(calls) / 10
    assert list(topics._group_steps(docs.iloc[:0], terms, [15.0] * 4, 0.5)) == []


def test_subsets_are_stemmed_once(spark, monkeypatch):
    """The counts that the index and the vectors are made of are read, not made from the texts again."""
    given = []
    monkeypatch.setattr(topic_plans, "topic_model", lambda counts, *a, **more: given.append(counts))
    songs = spark.createDataFrame([(i, "running cats flying") for i in range(10)], "lyrics_id long, lyrics string")
    songs = songs.withColumn("lyrics", F.when(F.col("lyrics_id") % 2 == 0, F.concat("lyrics", F.lit(" houses"))).otherwise(F.col("lyrics")))
    topic_plans.subset_topics(songs, [])
    assert "EvalPython" not in given[0]._jdf.queryExecution().toString()
    assert {r["term"] for r in given[0].collect()} == {"hous"}


def test_topic_weights(spark):
    docs = [(i, (["sun", "sea", "sand"] if i % 2 else ["gun", "cash", "car"]) * 5) for i in range(40)]
    df = spark.createDataFrame(docs, "id int, terms array<string>")
    counts = documents.document_terms(df, "terms", "id")
    model, index, vectors = topics.topic_model(counts, "id", 2, alpha=0.1, max_iter=30)
    beta = topics.topic_terms(model, index)
    described = {(r["topic"] + 1, i): w for r in model.describeTopics(6).collect() for i, w in zip(r["termIndices"], r["termWeights"])}
    places = {r["term"]: r["place"] for r in index.collect()}
    assert all(math.isclose(r["beta"], described[r["topic"], places[r["term"]]], rel_tol=1e-9) for r in beta.collect())
    assert beta.count() == 2 * 6
    assert all(math.isclose(r[1], 1.0) for r in beta.groupBy("topic").agg(F.sum("beta")).collect())
    gamma = topics.doc_topics(model, vectors, "id")
    assert gamma.count() == 80
    assert all(math.isclose(r[1], 1.0) for r in gamma.groupBy("id").agg(F.sum("gamma")).collect())
    top = topics.top_terms(beta, 3).collect()
    assert [r["topic"] for r in top] == sorted(r["topic"] for r in top) and len(top) >= 6


def _counted_terms(spark, n=60):
    """Counts of a small corpus, and how many texts were read for them so far."""
    texts, draw = spark.sparkContext.accumulator(0), random.Random(3)
    docs = spark.createDataFrame([(i, [f"w{draw.randrange(90)}" for _ in range(40)]) for i in range(n)], "id long, terms array<string>")

    def read(batches):
        for batch in batches:
            texts.add(batch.num_rows)
            yield batch

    return documents.document_terms(docs.mapInArrow(read, docs.schema), "terms", "id"), texts


def test_topic_passes_keep_one_table_of_weights(spark):
    """What a pass has written is gone after the next one: more passes leave no more folders and shuffle files."""
    spark.range(1).checkpoint()
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    files = lambda: int(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size())
    counts, left = _counted_terms(spark)[0], []
    for passes in (1, 7):
        topics.sweep(spark)
        time.sleep(3)
        before, shuffled = set(os.listdir(folder)), files()
        model = topics.topic_model(counts, "id", 3, max_iter=passes)[0]
        time.sleep(3)
        left.append((len(set(os.listdir(folder)) - before), files() - shuffled))
    assert model.weights.count() == 90 and left[1][0] == left[0][0]
    assert left[1][1] < left[0][1] + 40


def test_topic_model_reads_each_text_once(spark):
    """The index and the vectors are made of written counts."""
    counts, texts = _counted_terms(spark)
    _, index, vectors = topics.topic_model(counts, "id", 3, max_iter=1)
    assert texts.value == 60 and index.count() == 90 and vectors.count() == 60


def test_topics_of_fitted_documents_use_their_groups(spark, monkeypatch):
    """Documents are dealt to groups once for the passes and their own topics, and again for others, with equal topics."""
    calls, grouped = [], topics._grouped
    monkeypatch.setattr(topics, "_grouped", lambda *a: calls.append(a) or grouped(*a))
    monkeypatch.setattr(topics, "SLICE_ENTRIES", 30, raising=False)
    model, _, vectors = topics.topic_model(_counted_terms(spark)[0], "id", 3, max_iter=2)
    fitted = {(r["id"], r["topic"]): r["gamma"] for r in topics.doc_topics(model, vectors, "id").collect()}
    assert len(calls) == 1 and len(fitted) == 180
    other = {(r["id"], r["topic"]): r["gamma"] for r in topics.doc_topics(model, vectors.filter("id < 20"), "id").collect()}
    assert len(calls) == 2 and len(other) == 60 and all(math.isclose(other[x], fitted[x], rel_tol=1e-9) for x in other)


def test_topic_model_of_nothing(spark):
    counts = spark.createDataFrame([], "id long, term string, n long")
    model, index, vectors = topics.topic_model(counts, "id", 2, max_iter=2)
    assert topics.topic_terms(model, index).count() == 0 and topics.doc_topics(model, vectors, "id").count() == 0


def test_held_out_rows_have_both_labels_with_equal_seeds(spark):
    rows = [(k, int(k % 3 == 0), "rap words here" if k % 3 == 0 else "other song text") for k in range(120)]
    songs = spark.createDataFrame(rows, "lyrics_id long, rap int, lyrics string")
    featured = classify.with_features(classify.labelled_words(songs, "rap", [], seed=123), "count")
    held_out = classify.predict_held_out(featured, models.svm_pipeline(), seed=123).toPandas()
    assert held_out.label.value_counts().to_dict() == {1.0: 10, 0.0: 10}
    assert (held_out.label == held_out.prediction).all()
