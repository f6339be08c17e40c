"""Song-shaped views that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions.text import tokens
from refrain.operators.features import embedding_dict
from refrain.operators.genre import add_others, genre_flags
from refrain.operators.words import explode_words
from refrain.sources.tables import read_table, spread

# The stop words of the test corpus and the genre given to each last digit of the id.
STOP = "the of and to in a is that it for was on with be as by this are at from".split()
GENRE_OF_DIGIT = [
    "Pop-rock", "RandB-soul", "Hip-hop-rap", "Country-folk", "Dance-disco", "Blues-jazz",
    "Alternative-indie-rock", "Extraction failed", "Punk-metal", "Novelty",
]
CHART_SIZE = 100
# A text up to the end of its third word.
OPENING = r"^[^\p{L}\p{N}]*+(?:[\p{L}\p{N}]++(?:['’][\p{L}\p{N}]++)*+[^\p{L}\p{N}]*+){0,3}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as songs; ``song_name`` is the first three words."""
    docs = spread(table(spark, sf_dir, "documents"))
    digit = F.col("doc_id") % 10
    genre = F.lit(GENRE_OF_DIGIT[-1])
    for value, name in reversed(list(enumerate(GENRE_OF_DIGIT[:-1]))):
        genre = F.when(digit == value, name).otherwise(genre)
    return docs.select(
        F.col("doc_id").alias("lyrics_id"),
        (1968 + F.col("doc_id") % 50).cast("int").alias("year"),
        (1 + F.floor(F.col("doc_id") / 50) % CHART_SIZE).cast("int").alias("rank"),
        F.col("source").alias("singer"),
        "lang",
        F.array_join(F.slice(tokens(F.regexp_extract("text", OPENING, 0)), 1, 3), " ").alias("song_name"),
        F.col("text").alias("lyrics"),
        genre.alias("genre"),
    )


def flagged_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs with the 20 genre flags and ``others``."""
    return add_others(genre_flags(songs(spark, sf_dir)), fixed.GENRES)


def _benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "benchmark").select("text")
    return text.select(explode_words(tokens(F.col("text")), "word")).distinct().filter("word IS NOT NULL")


def lexicon_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (F.length("word") % 11).cast("int") - 5
    return _benchmark_words(spark, sf_dir).select("word", score.alias("score"))


def lexicon_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("score") > 0, "positive").otherwise("negative")
    return lexicon_scored(spark, sf_dir).filter("score <> 0").select("word", label.alias("sentiment"))


def lexicon_emotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two emotions per word."""
    number = F.explode(F.array(F.length("word") % 10, (F.length("word") + 3) % 10)).alias("_e")
    words = _benchmark_words(spark, sf_dir).select("word", number)
    return words.select("word", F.concat(F.lit("emotion"), F.col("_e")).alias("sentiment"))


def stop_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP], "word string")


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as annotated tokens, tagged by word length."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    sentences = docs.select(
        "doc_id", F.posexplode_outer(F.split(F.lower("text"), r"[.!?\n]+")).alias("sentence_id", "_s")
    )
    words = sentences.select(
        "doc_id", "sentence_id", F.posexplode_outer(tokens(F.col("_s"))).alias("token_id", "word")
    ).filter("word IS NOT NULL")
    kind = F.length("word") % 5
    return words.select(
        F.concat(F.lit("doc"), F.col("doc_id")).alias("doc_id"),
        F.lit(0).cast("bigint").alias("paragraph_id"),
        F.col("sentence_id").cast("bigint").alias("sentence_id"),
        F.col("token_id").cast("bigint").alias("token_id"),
        F.col("word").alias("token"),
        F.col("word").alias("lemma"),
        F.when(kind.isin(0, 3), "NOUN").when(kind == 1, "ADJ").when(kind == 2, "VERB").otherwise("PUNCT").alias("upos"),
        (F.col("token_id") + 1).cast("bigint").alias("head_token_id"),
        F.when(kind.isin(0, 3), "nsubj").otherwise("obj").alias("dep_rel"),
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark word with one of the given vectors, chosen by its hash."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    place = F.conv(F.substring(F.md5("word"), 1, 15), 16, 10).cast("bigint") % F.lit(vectors.count())
    return embedding_dict(_benchmark_words(spark, sf_dir).withColumn("vec_id", place).join(vectors, "vec_id"))


def chart_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows with some ranks replaced by the tie marker; ``lyrics_id`` orders them."""
    tie = F.col("lyrics_id") % 7 == 3
    rank = F.when(tie, "Tie").otherwise(F.col("rank").cast("string"))
    named = songs(spark, sf_dir).select("lyrics_id", "year", rank.alias("rank"), "song_name", "singer")
    return named


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One web page per year and hundred songs, the song rows in its last table: ``(page, year, html)``."""
    cell = "<tr><td>%s</td><td>\"%s\"</td><td>%s</td></tr>"
    row = F.format_string(cell, "rank", "song_name", "singer")
    rows = chart_raw(spark, sf_dir).withColumn("page", F.floor(F.col("lyrics_id") / (50 * CHART_SIZE)))
    page = rows.groupBy("year", "page").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("lyrics_id", row.alias("r"))))["r"], "").alias("body")
    )
    head = '<html><body><div id="mw-content-text"><div><table><tr><td>note</td></tr></table><table>'
    titles = "<tr><th>No.</th><th>Title</th><th>Artist(s)</th></tr>"
    html = F.concat(F.lit(head + titles), "body", F.lit("</table></div></div></body></html>"))
    return page.select(F.format_string("%d-%d", "year", "page").alias("page"), "year", html.alias("html"))


# What stands between two names, one for each branch of the artist key.
BETWEEN = [" Featuring ", " featuring ", " with ", " The ", " & ", "-", " x ", " + "]


def named_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs whose titles and artists hold an alias, or two names put together in each of the known ways."""
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    base = songs(spark, sf_dir).select("lyrics_id", "song_name", "singer")
    number = F.col("lyrics_id")
    title = F.concat(pick([p for p, _ in fixed.TITLE_ALIASES], F.floor(number / 3)), F.lit(" "), "song_name")
    alias = pick([p for p, _ in fixed.ARTIST_ALIASES], F.floor(number / 4))
    joined = F.concat(F.col("singer"), pick(BETWEEN, number), F.lit("other"))
    return base.select(
        "lyrics_id",
        F.when(number % 3 == 0, title).otherwise(F.col("song_name")).alias("title"),
        F.when(number % 4 == 0, alias).when(number % 16 == 1, F.col("singer")).otherwise(joined).alias("artist"),
    )


def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs with a raw search text that reaches each extraction branch."""
    base = songs(spark, sf_dir).select("lyrics_id", "year", "rank", "song_name", "singer", F.col("genre").alias("g"))
    kind = F.col("lyrics_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("(x) "), "singer", F.lit(" Genre: "), "g", F.lit(" Length: 3:20")))
        .when(kind == 1, F.concat(F.lit("-"), "singer", F.lit("-foo-Genres-"), "g"))
        .when(kind == 2, F.concat(F.lit("other Genre "), "g"))
        .otherwise(F.concat(F.lit("page about "), "singer"))
    )
    return base.withColumn("genre_raw", raw).withColumn("song_name_dash", F.col("singer")).drop("g")


def cited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs without a detected genre, two thirds of which cite a page, some of them a missing one."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("lyrics_id"), "url")
    base = songs(spark, sf_dir).select("lyrics_id", "singer").join(pages, "lyrics_id", "left")
    address = F.coalesce("url", F.concat(F.lit("http://missing.example/"), F.col("lyrics_id")))
    raw = F.when(F.col("lyrics_id") % 3 == 0, F.concat(F.lit("page about "), "singer")).otherwise(
        F.concat(F.lit("wiki Wikipedia"), address, F.lit("Cached copy"))
    )
    return base.select("lyrics_id", raw.alias("genre_raw"), F.lit(fixed.NO_GENRE).alias("genre"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of the raw pages: ``(url, pos, text)``, cut at paragraph tags."""
    lines = F.posexplode(F.split("html", "<p>")).alias("pos", "text")
    return table(spark, sf_dir, "pages").select("url", lines)
