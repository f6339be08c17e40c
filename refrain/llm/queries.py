"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm import best_fit, collocations, embedding_dedup, language_model, mixing, ngram_join, packing, periodic_runs
from refrain.llm import pii, quality_classifier, quality_rules, url_filters, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    """Where the public tokenizer files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_filters(spark, d):
    """Verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, d, "pages"), rules)


GOOD = 0.7


def remainder(key: str, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(key).cast("string")) % n


@query
def op2_quality_classifier(spark, d):
    """Quality score of every document, learned from the labels that are not held out."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    trees = quality_classifier.train(docs, labels.filter(remainder("doc_id", 4) != 2))
    scored = quality_classifier.score(docs, trees)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query
def op3_warc(spark, d):
    """Every page written to archives and read back."""
    back = warc.read_archives(spark, warc.write_archives(table(spark, d, "pages")))
    return back.select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").alias("refers_to"), "complete"
    )


@query
def op5_mixing(spark, d):
    """Words that the mix takes of every document."""
    mixed = mixing.mix(table(spark, d, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query
def op6_quality_rules(spark, d):
    """Counts, base failures and verdict of every document."""
    return quality_rules.apply_rules(table(spark, d, "documents"))


@query
def op10_packing(spark, d):
    """Every piece of every document and its place in the packed sequences."""
    return packing.pack(table(spark, d, "documents"), vocabulary()).drop("source")


@query
def op9_pii(spark, d):
    """Personal data of every document; counts and hash are of the base spans."""
    docs = table(spark, d, "documents")
    found = pii.detect(docs, pii.train(docs)).drop("masked")
    coded = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(coded(F.col("base")), 256).alias("base_sha256"),
        coded(F.col("spans")).alias("spans"),
    )


@query
def op8_language_model(spark, d):
    """Exact base score and model score of every document."""
    held_out = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False))
    scored = language_model.score(table(spark, d, "documents"), ~held_out)
    return scored.withColumn("held_out", held_out)


@query
def op7_ngram_join(spark, d):
    """Class and number of links of every document."""
    return ngram_join.join(table(spark, d, "documents")).drop("text_hash")


@query
def op4_embedding_dedup(spark, d):
    """Links and component of every vector."""
    found = embedding_dedup.near_duplicates(table(spark, d, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query
def op11_collocations(spark, d):
    """The best phrases of two and three words of every language."""
    return collocations.collocations(table(spark, d, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents whose id's hash ends in 0 repeat a stretch of their own words up to their end."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    shaped = docs.select("doc_id", "text", F.when(hashed % 10 == 0, words).alias("words"), F.floor(hashed / 10).alias("g"))
    n = F.size("words").cast("long")
    shaped = shaped.withColumn("first", F.when(n > 0, F.col("g") % n))
    shaped = shaped.withColumn("period", 1 + F.floor((n - F.col("first")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("first"), i).otherwise(F.col("first") + (i - F.col("first")) % F.col("period"))
    planted = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", source(i).cast("int")))
    return shaped.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, d):
    """Periodic runs of every document, the longest one, and digests of all runs and of the text without repeats."""
    found = periodic_runs.find_runs(with_planted_runs(table(spark, d, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # The longest; of equally long ones the first in order of start and period.
    longest = F.reduce("runs", F.element_at("runs", 1), lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best))
    found = found.withColumn("best", F.when(F.size("runs") > 0, longest))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_best_fit_packing(spark, d):
    """Every piece of every document and its place in as few sequences as the plan finds."""
    return best_fit.pack(table(spark, d, "documents"), vocabulary())
