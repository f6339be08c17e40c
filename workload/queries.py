"""One Spark query per registered operator or report. Each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.keys import canon_title, with_artist_key, with_lyric_url, with_name_keys
from refrain.functions.text import clean_scraped, dash_key, decade, genre_search_url, normalise
from refrain.operators import annotate, distribution, documents, features, joins, models, ranking, richness
from refrain.operators import sampling, sentiment, topics, vocabulary, words
from refrain.operators.genre import clean_genre, extract_genre, extraction_report, genre_fallback, genre_long
from refrain.operators.genre import genre_status
from refrain.operators.ordered import add_index, fill_ties
from refrain.plans import annotation as annotation_plans
from refrain.plans import chart as chart_plans
from refrain.plans import classify, fill, sentiment as sentiment_plans, topics as topic_plans, words as word_plans
from refrain.session import pin, shared_path
from refrain.sources.html import html_tables, html_text
from refrain.sources.status import parsed_rows, with_status, write_by_status
from refrain.sources.tables import collect_by_key, read_table
from workload import views
from workload.views import STOP

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = fixed.SPLIT_SEED
GRID = [-5 + 0.5 * i for i in range(21)]
RELEVANT = ["NOUN", "ADJ"]
CV_ITERATIONS = 20  # of each of the 30 fits


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r9(name: str) -> Column:
    return F.round(F.col(name), 9).alias(name)


def relevant() -> Column:
    return F.col("upos").isin(RELEVANT)


def song_tokens(spark, d, *keep: str) -> DataFrame:
    return words.unnest_tokens(views.songs(spark, d).select(*keep, "lyrics"), "word", "lyrics")


def prepared(spark, d) -> DataFrame:
    """Annotated tokens without punctuation."""
    return views.annotated(spark, d).filter("upos <> 'PUNCT'")


# Sources


@query
def scan_songs(spark, d):
    return views.songs(spark, d)


@query
def html_tables_(spark, d):
    pages = views.chart_pages(spark, d)
    rows = html_tables(pages, "page", which=-1, path=chart_plans.CHART_PATH)
    return rows.select("page", "row_no", F.array_join("cells", "|").alias("cells"))


@query
def html_text_(spark, d):
    return html_text(views.table(spark, d, "pages"), "page_id", "h1")


@query
def clean_scraped_(spark, d):
    docs = views.spread(views.table(spark, d, "documents"))
    return docs.select("doc_id", clean_scraped(F.col("text")).alias("cleaned"))


@query
def collect_by_year(spark, d):
    """One frame per year, each from a table of its own; the columns differ."""
    names = {1968: ("documents", "doc_id"), 1969: ("benchmark", "item_id"), 1970: ("conversations", "conv_id")}
    frames = {
        year: views.table(spark, d, name).withColumns({"id": F.col(key), "size": F.length("text")})
        for year, (name, key) in names.items()
    }
    return collect_by_key(frames, "year").select("year", "id", "size", "lang", "role")


@query
def parse_status(spark, d):
    chart = views.chart_raw(spark, d).select("lyrics_id", F.col("rank").alias("raw"))
    parsed = F.col("raw").try_cast("int")
    return with_status(chart, "raw", parsed, "rank", suspicious=F.col("rank") > 90)


@query
def embedding_sum(spark, d):
    vectors = views.table(spark, d, "embeddings").withColumnRenamed("vec_id", "word")
    return features.embedding_dict(vectors).select("word", F.round("vec_sum", 6).alias("vec_sum"))


@query
def scan_annotated(spark, d):
    return views.annotated(spark, d)


@query
def lyric_url(spark, d):
    songs = views.songs(spark, d).select("lyrics_id", "song_name", "singer")
    return with_lyric_url(songs, "song_name", "singer")


# Chart, keys and genre


@query
def decade_bucket(spark, d):
    return views.songs(spark, d).select("lyrics_id", "year", decade(F.col("year")).alias("decade"))


@query
def dense_index(spark, d):
    songs = views.songs(spark, d).select("lyrics_id", "year", "rank")
    return add_index(songs, ["year", "rank", "lyrics_id"], "idx")


@query
def rank_tie_fill(spark, d):
    chart = views.chart_raw(spark, d).select("lyrics_id", "year", "rank")
    return fill_ties(chart, ["year"], ["lyrics_id"], "rank")


@query
def rank_tie_runs(spark, d):
    """Ranks with up to three ties in a row, filled from the row before and from the last real rank."""
    tied = F.when(F.col("lyrics_id") % 7 < 3, "Tie").otherwise(F.col("rank").cast("string"))
    chart = views.songs(spark, d).select("lyrics_id", "year", tied.alias("rank"))
    return collect_by_key({way: fill_ties(chart, ["year"], ["lyrics_id"], "rank", fill=way) for way in ("prev", "run")}, "way")


@query
def title_dash(spark, d):
    docs = views.spread(views.table(spark, d, "documents"))
    return docs.select("doc_id", dash_key(F.col("text")).alias("dash"))


@query
def chart_clean(spark, d):
    rows = chart_plans.chart_rows(views.chart_pages(spark, d), "page")
    key = F.split("page", "-")
    rows = rows.select(
        F.get(key, F.lit(0)).cast("int").alias("year"),
        F.get(key, F.lit(1)).cast("int").alias("page_no"),
        "row_no", "rank", "song_name", "singer",
    )
    return chart_plans.chart_clean(rows, ["year"], ["page_no", "row_no"], block=F.col("page_no"))


@query
def canon_title_(spark, d):
    return views.songs(spark, d).select("lyrics_id", canon_title(F.col("lyrics"), mode="regex").alias("title_key"))


@query
def canon_artist(spark, d):
    keyed = with_artist_key(views.songs(spark, d).select("lyrics_id", "lyrics"), "lyrics", "artist_key", mode="regex")
    return keyed.select("lyrics_id", "artist_key")


@query
def genre_search_url_(spark, d):
    """The address that each song's genre is searched at."""
    named = views.named_songs(spark, d)
    return named.select("lyrics_id", genre_search_url(F.col("title"), F.col("artist")).alias("search_url"))


@query
def name_keys(spark, d):
    """Keys of titles and artists that hold aliases and reach every branch."""
    return with_name_keys(views.named_songs(spark, d), "title", "artist")


@query
def genre_clean(spark, d):
    docs = views.spread(views.table(spark, d, "documents"))
    return docs.select("doc_id", clean_genre(F.col("text")).alias("cleaned"))


@query
def genre_extract(spark, d):
    found = extract_genre(views.search_texts(spark, d), "genre_raw", "song_name_dash")
    return found.select("lyrics_id", "genre", genre_status(F.col("genre")).alias("genre_status"))


@query
def genre_failures(spark, d):
    return extraction_report(extract_genre(views.search_texts(spark, d), "genre_raw", "song_name_dash"))


@query
def genre_fallback_(spark, d):
    return genre_fallback(views.cited_texts(spark, d), views.page_lines(spark, d), marker="the")


@query
def genre_flags(spark, d):
    return views.flagged_songs(spark, d).select("lyrics_id", *fixed.GENRES)


@query
def genre_others(spark, d):
    return views.flagged_songs(spark, d).select("lyrics_id", "others")


@query
def genre_long_(spark, d):
    flags = [*fixed.GENRES, "others"]
    return genre_long(views.flagged_songs(spark, d).select("lyrics_id", "year", *flags), flags)


@query
def genre_pipeline(spark, d):
    built = chart_plans.genre_build(views.search_texts(spark, d))
    return built.select("lyrics_id", "genre", *fixed.GENRES, "others")


# Joins


@query
def join_chart_lyrics(spark, d):
    songs = views.songs(spark, d)
    lyrics = songs.select("song_name", "singer", F.md5("lyrics").alias("lyrics"))
    return joins.join_chart_lyrics(songs.select("rank", "song_name", "singer", "year"), lyrics, every_text=True)


@query
def join_genre(spark, d):
    songs = views.songs(spark, d).withColumn("lyrics", F.md5("lyrics"))
    raw = F.concat(F.lit("raw "), F.col("genre"))
    status = F.when(F.col("lyrics_id") % 10 == 8, fixed.PAGE_MISSING).otherwise(F.col("genre"))
    genres = songs.select(*joins.SONG_KEY, raw.alias("genre_raw"), status.alias("genre"))
    return joins.join_genre(songs.select(*joins.SONG_KEY, "lyrics"), genres)


@query
def missing_lyrics(spark, d):
    songs = views.songs(spark, d)
    have = songs.filter(F.col("lyrics_id") % 4 != 0)
    return joins.missing_rows(songs.select("lyrics_id", *joins.SONG_KEY), have)


@query
def lyrics_fill(spark, d):
    songs = views.songs(spark, d).withColumn("lyrics", F.md5("lyrics"))
    stored = songs.filter(F.col("lyrics_id") % 4 != 0)
    fetched = songs.filter(F.col("lyrics_id") % 8 == 0)
    return joins.lyrics_fill(songs, stored, fetched, every_text=True)


def parse_rank(text: str) -> str:
    """A chart rank without leading zeros; a tie is no rank, and one beyond the chart is suspicious."""
    if not text.isdecimal():
        raise ValueError(f"no rank: {text}")
    if int(text) > 90:
        raise Warning(f"low rank: {text}", text)
    return str(int(text))


@query
def parse_messages(spark, d):
    """Chart ranks parsed row by row, good and failed rows written in one pass and read again."""
    chart = views.chart_raw(spark, d).select("lyrics_id", F.when(F.col("lyrics_id") % 11 != 5, F.col("rank")).alias("rank"))
    path = shared_path(spark, "parsed")
    write_by_status(parsed_rows(chart, "rank", parse_rank), path)
    return read_table(spark, path).select("lyrics_id", "rank", "value", "status", "message")


@query
def lyrics_store(spark, d):
    """Rows per year of a stored table after a round of filling, the rows added, and whether its files are the old ones."""
    songs = views.songs(spark, d).withColumn("lyrics", F.md5("lyrics"))
    path = shared_path(spark, "lyrics-store")
    fill.start_store(songs.filter(F.col("lyrics_id") % 4 != 0), path)
    files = lambda: read_table(spark, path).groupBy("year").agg(
        F.array_sort(F.collect_set("_metadata.file_name")).alias("files"), F.count("*").alias("rows"))
    before = pin(files())
    added = fill.fill_store(songs.filter("year < 1990"), songs.filter("lyrics_id % 8 = 0"), path)
    after = files().join(before.select("year", F.col("files").alias("old")), "year", "left").join(added, "year", "left")
    kept = F.coalesce(F.col("files") == F.col("old"), F.lit(False))
    return after.select("year", "rows", F.coalesce("added", F.lit(0)).alias("added"), kept.alias("same_files"))


# Words


@query
def tokenize(spark, d):
    return words.unnest_tokens(views.songs(spark, d).select("lyrics_id", "lyrics"), "word", "lyrics", keep_pos=True)


@query
def stopword_anti(spark, d):
    return words.remove_stopwords(song_tokens(spark, d, "lyrics_id"), views.stop_table(spark))


@query
def word_freq(spark, d):
    return word_plans.top_words(views.songs(spark, d), STOP)


@query
def wordcloud_freq(spark, d):
    return word_plans.cloud_words(views.songs(spark, d), views.stop_table(spark))


@query
def word_freq_by_decade(spark, d):
    return word_plans.words_by_decade(views.songs(spark, d), STOP)


@query
def word_freq_pop(spark, d):
    return word_plans.words_of_genre(views.flagged_songs(spark, d), "pop", STOP)


@query
def word_freq_singer(spark, d):
    return word_plans.words_of_singer(views.songs(spark, d), "src3", STOP)


@query
def top_artists(spark, d):
    return word_plans.top_artists(views.songs(spark, d))


@query
def tfidf_by_song(spark, d):
    return word_plans.tf_idf_by_song(views.songs(spark, d)).select(
        "lyrics_id", "song_name", "word", "n", r9("tf"), r9("idf"), r9("tf_idf")
    )


@query
def tfidf_by_decade(spark, d):
    return word_plans.tf_idf_by_decade(views.songs(spark, d)).select("decade", "word", "n", r9("tf_idf"), "x")


@query
def tfidf_by_genre(spark, d):
    flags = [*fixed.GENRES, "others"]
    top = word_plans.tf_idf_by_genre(views.flagged_songs(spark, d), flags, fixed.TFIDF_GENRES)
    return top.select("genre_tidy", "word", "n", r9("tf_idf"), "x")


@query
def tfidf_by_singer(spark, d):
    return word_plans.tf_idf_by_singer(views.songs(spark, d)).select("singer", "word", "n", r9("tf_idf"))


@query
def top_artist_tfidf(spark, d):
    return word_plans.tf_idf_of_top_artists(views.songs(spark, d)).select("singer", "word", "n", r9("tf_idf"), "x")


@query
def lexical_richness(spark, d):
    songs = views.songs(spark, d).select("lyrics_id", "lyrics")
    return richness.song_richness(songs, STOP).select("lyrics_id", r9("richness"))


@query
def richness_by_decade(spark, d):
    return word_plans.richness_by_decade(views.songs(spark, d), STOP).select("decade", r9("avg_richness"))


@query
def richness_by_genre_decade(spark, d):
    rich = word_plans.richness_by_genre_decade(views.flagged_songs(spark, d), fixed.REPORT_GENRES, STOP)
    return rich.select("genre_tidy", "decade", r9("avg_richness"))


# Sentiment


def scored_songs(spark, d, *keep: str) -> DataFrame:
    songs = views.songs(spark, d).withColumn("decade", decade(F.col("year")))
    return sentiment.song_sentiment(songs, views.lexicon_scored(spark, d), list(keep))


@query
def sentiment_bing(spark, d):
    return sentiment.sentiment_net(song_tokens(spark, d, "lyrics_id"), views.lexicon_labelled(spark, d))


@query
def sentiment_afinn(spark, d):
    return sentiment.sentiment_score(song_tokens(spark, d, "lyrics_id"), views.lexicon_scored(spark, d))


@query
def sentiment_normalised(spark, d):
    return scored_songs(spark, d).select("lyrics_id", "sentiment", "lyrics_length", r9("ave_sentiment"))


@query
def sentiment_nrc(spark, d):
    profile = sentiment_plans.emotions_by_genre(
        views.flagged_songs(spark, d), views.lexicon_scored(spark, d), views.lexicon_emotions(spark, d)
    )
    return profile.select("genre", "sentiment", "total", "n_group", r9("relative_sentiment"))


def _mean(group: str) -> Query:
    def run(spark, d):
        songs = views.songs(spark, d).withColumn("decade", decade(F.col("year")))
        return sentiment_plans.mean_sentiment(songs, views.lexicon_scored(spark, d), group).select(
            group, r9("mean_sent")
        )

    return run


QUERIES["mean_sentiment_by_rank"] = _mean("rank")
QUERIES["mean_sentiment_by_year"] = _mean("year")
QUERIES["mean_sentiment_by_decade"] = _mean("decade")


@query
def mean_sentiments(spark, d):
    """The reports by rank, year and decade from one pass over the texts."""
    songs = views.songs(spark, d).withColumn("decade", decade(F.col("year")))
    means = sentiment_plans.mean_sentiments(songs, views.lexicon_scored(spark, d), ["rank", "year", "decade"])
    return means.select("by", "group", r9("mean_sent"))


@query
def mean_sentiment_by_genre(spark, d):
    means = sentiment_plans.mean_sentiment_by_genre(views.flagged_songs(spark, d), views.lexicon_scored(spark, d))
    return means.select("genre_tidy", r9("mean_sent"), "ord")


def _tidy(spark, d) -> DataFrame:
    return sentiment_plans.genre_tidy(views.flagged_songs(spark, d), views.lexicon_scored(spark, d))


@query
def genre_tidy(spark, d):
    return _tidy(spark, d).select(
        "lyrics_id", "sentiment", "lyrics_length", r9("ave_sentiment"), "rank", "decade", "year", "genre_tidy"
    )


@query
def genre_share_by_decade(spark, d):
    return sentiment_plans.genre_shares(_tidy(spark, d)).select("decade", "genre_tidy", "n_genre_occ", r9("perc"))


@query
def extreme_sentiment(spark, d):
    songs, lexicon = views.songs(spark, d), views.lexicon_scored(spark, d)
    high = sentiment_plans.extreme_songs(songs, lexicon, "1970s", above=fixed.EXTREME_SENTIMENT)
    low = sentiment_plans.extreme_songs(songs, lexicon, "2010s", below=-fixed.EXTREME_SENTIMENT)
    return high.unionByName(low).select(
        "lyrics_id", "song_name", "singer", "rank", "year", "decade", "sentiment", r9("ave_sentiment"),
        F.md5("lyrics").alias("lyrics_md5"),
    )


@query
def sentiment_density(spark, d):
    scored = scored_songs(spark, d, "decade")
    curve = distribution.density_by_group(scored, ["decade"], "ave_sentiment", GRID, 0.3, binned=False)
    return curve.select("decade", "x", r9("density"))


@query
def sentiment_density_default(spark, d):
    """Density by decade with the bandwidth that follows from the values."""
    curve = distribution.density_by_group(pin(scored_songs(spark, d, "decade")), ["decade"], "ave_sentiment", GRID)
    return curve.select("decade", "x", r9("density"))


@query
def sentiment_density_by_rank(spark, d):
    scored = scored_songs(spark, d, "rank")
    axis = [-0.2 + 0.05 * i for i in range(21)]
    bands = {"top": sentiment_plans.rank_band(scored, 1, 20), "bottom": sentiment_plans.rank_band(scored, 81, 100)}
    curves = {name: sentiment_plans.sentiment_density(band, ["rank"], axis, 0.1) for name, band in bands.items()}
    return collect_by_key(curves, "band").select("band", "rank", r9("x"), r9("density"))


@query
def sentiment_histogram(spark, d):
    scored = scored_songs(spark, d, "decade")
    return distribution.histogram_by_group(scored, ["decade"], "ave_sentiment", -1.0, 1.0, 20)


# Annotated tokens


@query
def prepare_annotated(spark, d):
    songs = views.songs(spark, d).select("lyrics_id", "song_name", "year", "rank", "singer")
    return annotate.prepare_annotated(views.annotated(spark, d), songs)


@query
def top_nouns(spark, d):
    return annotate.top_lemmas(prepared(spark, d), "NOUN", [], 20)


@query
def top_nouns_by_decade(spark, d):
    return annotation_plans.lemmas_by_decade(views.annotated(spark, d), views.songs(spark, d), "NOUN")


@query
def top_adj_by_decade(spark, d):
    return annotation_plans.lemmas_by_decade(views.annotated(spark, d), views.songs(spark, d), "ADJ")


@query
def top_nouns_by_genre(spark, d):
    songs = views.flagged_songs(spark, d)
    return annotation_plans.lemmas_by_genre(views.annotated(spark, d), songs, fixed.REPORT_GENRES, "NOUN")


@query
def top_adj_by_genre(spark, d):
    songs = views.flagged_songs(spark, d)
    return annotation_plans.lemmas_by_genre(views.annotated(spark, d), songs, fixed.REPORT_GENRES, "ADJ")


@query
def dependency_pairs(spark, d):
    return annotate.dependency_pairs(prepared(spark, d))


@query
def dependency_top(spark, d):
    return annotation_plans.top_phrases(prepared(spark, d))


@query
def cooccurrence(spark, d):
    return annotate.cooccurrence(prepared(spark, d), relevant())


@query
def word_network(spark, d):
    edges, nodes = annotate.word_network(annotate.cooccurrence(prepared(spark, d), relevant()), 150)
    names = nodes.select(F.col("name").alias("term1"), F.lit("").alias("term2"), F.lit(0).cast("bigint").alias("cooc"))
    return collect_by_key({"edge": edges, "node": names}, "kind")


@query
def rake_keywords(spark, d):
    keywords = annotate.rake_keywords(prepared(spark, d), relevant())
    return keywords.select("keyword", "ngram", "freq", r9("rake"))


@query
def rake_top(spark, d):
    top = annotation_plans.top_keywords(prepared(spark, d), relevant())
    return top.select("keyword", "ngram", "freq", r9("rake"), "x")


# Corpus and document-term table


def _plain_terms(spark, d) -> DataFrame:
    songs = views.songs(spark, d).select("lyrics_id", "lyrics")
    return documents.normalise_corpus(songs, "lyrics", STOP, stemmed=False, min_len=3)


@query
def normalise_text(spark, d):
    return views.songs(spark, d).select("lyrics_id", normalise(F.col("lyrics")).alias("text"))


@query
def stem_tokens(spark, d):
    return documents.stem_tokens(song_tokens(spark, d, "lyrics_id"))


@query
def doc_term_bounds(spark, d):
    return documents.doc_term(_plain_terms(spark, d), "terms", "lyrics_id")


@query
def nonempty_docs(spark, d):
    terms = _plain_terms(spark, d)
    dt = documents.doc_term(terms, "terms", "lyrics_id")
    return documents.nonempty_docs(terms.select("lyrics_id"), dt, "lyrics_id")


@query
def dtm_summary(spark, d):
    terms = _plain_terms(spark, d)
    dt = documents.doc_term(terms, "terms", "lyrics_id")
    summary = documents.dtm_summary(dt, terms.agg(F.count("*")).scalar())
    return summary.select("docs", "terms", "non_zero", r9("sparsity"))


@query
def top_terms(spark, d):
    tok = words.unnest_tokens(
        views.songs(spark, d).select((F.col("year") % 10).alias("topic"), "lyrics"), "term", "lyrics"
    )
    counts = words.word_freq(tok, ["topic"], word="term")
    beta = ranking.share_of(counts, "n", ["topic"], out="beta").select("topic", "term", "beta")
    return topics.top_terms(beta, 10).select("topic", "term", r9("beta"), "order")


# Topic models


@query
def lda_topics(spark, d):
    model, index, _ = topic_plans.corpus_topics(views.songs(spark, d), STOP)
    return topics.top_terms(topics.topic_terms(model, index), 10)


@query
def lda_topics_subset(spark, d):
    songs = views.flagged_songs(spark, d)
    parts = {
        "1970s": songs.filter(decade(F.col("year")) == "1970s"),
        "2010s": songs.filter(decade(F.col("year")) == "2010s"),
        "disco": songs.filter("disco = 1"),
        "rap": songs.filter("rap = 1"),
    }
    return topic_plans.top_terms_of_subsets(parts, STOP)


@query
def lda_beta(spark, d):
    model, index, _ = topic_plans.corpus_topics(views.songs(spark, d), STOP)
    return topics.topic_terms(model, index)


@query
def lda_gamma(spark, d):
    model, _, vectors = topic_plans.corpus_topics(views.songs(spark, d), STOP)
    return topics.doc_topics(model, vectors, "lyrics_id")


@query
def topic_facts(spark, d):
    """What must hold of any topic model of the plain terms: per topic its terms and the sum of their weights, and how
    many documents have a weight for it."""
    counts = documents.document_terms(_plain_terms(spark, d), "terms", "lyrics_id")
    model, index, vectors = topics.topic_model(counts, "lyrics_id", fixed.TOPICS_SUBSET, max_iter=3)
    beta = topics.topic_terms(model, index).groupBy("topic")
    gamma = topics.doc_topics(model, vectors, "lyrics_id").groupBy("topic")
    terms = beta.agg(F.count("*").alias("terms"), F.countDistinct("term").alias("names"), F.round(F.sum("beta"), 6).alias("beta_sum"))
    return terms.join(gamma.agg(F.count("*").alias("docs")), "topic")


# Features and classifiers


def _labelled_docs(spark, d) -> DataFrame:
    """Labelled songs, with the label as a flag."""
    labels = views.table(spark, d, "labels").select(F.col("doc_id").alias("lyrics_id"), F.col("toxic").alias("flag"))
    return views.songs(spark, d).join(labels, "lyrics_id")


def _labelled_tokens(spark, d) -> DataFrame:
    docs = _labelled_docs(spark, d).select("lyrics_id", "flag", "lyrics")
    return words.remove_stopwords(words.unnest_tokens(docs, "word", "lyrics"), STOP)


@query
def class_balance(spark, d):
    docs = _labelled_docs(spark, d).select("lyrics_id", "flag")
    return sampling.class_balance(docs, "flag", "lyrics_id", SEED)


@query
def train_test_split(spark, d):
    train, test = sampling.train_test_split(
        views.table(spark, d, "documents").select("doc_id", "source"), "doc_id", fixed.TRAIN_SHARE, SEED
    )
    return collect_by_key({"train": train, "test": test}, "part")


@query
def features_count(spark, d):
    return features.count_features(_labelled_tokens(spark, d), ["lyrics_id", "flag"])


@query
def features_binary(spark, d):
    return features.binary_features(_labelled_tokens(spark, d), ["lyrics_id", "flag"])


@query
def features_embedding(spark, d):
    long = features.embedding_features(_labelled_tokens(spark, d), views.dictionary(spark, d), ["lyrics_id", "flag"])
    return long.select("lyrics_id", "flag", "word", F.round("value", 6).alias("value"))


@query
def features_sumvec(spark, d):
    sums = features.embedding_sum_feature(_labelled_tokens(spark, d), views.dictionary(spark, d), ["lyrics_id", "flag"])
    return sums.select("lyrics_id", "flag", F.round("sum_vec", 5).alias("sum_vec"))


@query
def confusion_matrix(spark, d):
    labels = views.table(spark, d, "labels")
    pred = labels.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    scores = [r9(c) for c in ("accuracy", "kappa", "sensitivity", "specificity")]
    return models.confusion_matrix(pred).select("tp", "fp", "fn", "tn", *scores)


def _featured(spark, d, kind: str) -> DataFrame:
    docs = _labelled_docs(spark, d).select("lyrics_id", "flag", "lyrics")
    labelled = classify.labelled_words(docs, "flag", STOP, SEED)
    return classify.with_features(labelled, kind, views.dictionary(spark, d))


@query
def word_index(spark, d):
    """The numbered words of the labelled documents."""
    long = features.count_features(_labelled_tokens(spark, d), ["lyrics_id", "flag"])
    n_docs = _labelled_docs(spark, d).agg(F.count("*")).scalar()
    return vocabulary.word_index(long, n_docs, fixed.MIN_DOC_SHARE)


def _vector_entries(kind: str) -> Query:
    """Vectors of one kind as places and values, the values rounded and joined to a text."""

    def run(spark, d):
        docs = _labelled_docs(spark, d).select("lyrics_id", F.col("flag").cast("double").alias("label"), words.text_words("lyrics", STOP).alias("words"))
        vectors = classify.with_features(pin(docs), kind, views.dictionary(spark, d))
        entries = vocabulary.vector_entries(vectors, ["lyrics_id", "label"])
        values = F.transform("values", lambda v: F.round(v * 1000).cast("long").cast("string"))
        places = F.transform("places", lambda p: p.cast("string"))
        return entries.select("lyrics_id", "label", "size", F.array_join(places, " ").alias("places"), F.array_join(values, " ").alias("values"))

    return run


for _kind in ("count", "binary", "embedding"):
    QUERIES[f"vectors_{_kind}"] = _vector_entries(_kind)


@query
def cv_folds(spark, d):
    """Rows of every fold, label and repeat of the cross-validation."""
    docs = _labelled_docs(spark, d).select("lyrics_id", F.col("flag").alias("label"))
    parts = {
        repeat: sampling.fold_numbers(docs, "lyrics_id", "label", fixed.CV_FOLDS, f"{SEED}-fold-{repeat}")
        for repeat in range(1, fixed.CV_REPEATS + 1)
    }
    dealt = collect_by_key(parts, "repeat")
    return dealt.groupBy("repeat", "fold", "label").agg(F.count("*").alias("rows"), F.sum("lyrics_id").alias("id_sum"))


@query
def split_by_label(spark, d):
    """The classifier's split: a share of each label, in an order of its own."""
    docs = _labelled_docs(spark, d).select("lyrics_id", F.col("flag").alias("label"))
    return sampling.mark_train(docs, "lyrics_id", fixed.TRAIN_SHARE, f"{SEED}-split", stratum="label")


def _svm(kind: str) -> Query:
    return lambda spark, d: classify.evaluate(_featured(spark, d, kind), models.svm_pipeline())


for _kind in classify.FEATURES:
    QUERIES[f"svm_{_kind}"] = _svm(_kind)


@query
def logit_count(spark, d):
    return classify.evaluate(_featured(spark, d, "count"), models.logit_pipeline(reg=0.01))


@query
def repeated_cv(spark, d):
    featured = _featured(spark, d, "count")
    return models.repeated_cv(models.svm_pipeline(max_iter=CV_ITERATIONS), featured, fixed.CV_FOLDS, fixed.CV_REPEATS, SEED)


# A trailing underscore only keeps a query from hiding the operator it runs.
QUERIES = {name.rstrip("_"): fn for name, fn in QUERIES.items()}
