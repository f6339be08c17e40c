"""The corpus pipeline: quality, near-duplicates, personal data, mixture, packing.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last one
returns packed pieces. Between stages the documents are written as Parquet to the session's shared folder.

Edge cases hold in all stages: texts may be null or empty, ids null or repeated, rows equal, tables empty, and
further columns of any name ride along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm import mixing, ngram_join, packing, pii, quality_classifier
from refrain.llm.queries import GOOD, vocabulary
from refrain.llm.store import stored

# SQL can't state trained scores, trained spans or tilted rates; tests compare the stages with brute force.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> DataFrame:
    """Columns named c0, c1, ... so that no name can clash with a result."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def _of(docs: DataFrame, name: str) -> str:
    return f"c{docs.columns.index(name)}"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the mark; rows of equal texts fare alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality_classifier.train(docs, labels)
    rows = _numbered(docs)
    scored = quality_classifier.score(rows, trees, text=_of(docs, "text"), keep=rows.columns, name="score")
    return scored.filter(F.col("score") >= GOOD).drop("score").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id, null ids last, then the least text hash.

    Of rows with equal id and text one stays. Rows without shingles have no near copies; without an id they all stay.
    """
    found = stored(ngram_join.grouped(docs), "near-found")
    keys = found.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    least = keys.filter("`group` is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("k"))
    alone = keys.filter("`group` is null").select("doc_id", "text_hash", F.when(F.col("doc_id").isNull(), 1).otherwise(F.col("n")).alias("n"))
    kept = stored(least.select("k.doc_id", "k.text_hash", "k.n").union(alone), "near-kept")
    rows = _numbered(docs)
    key = [F.col(_of(docs, "doc_id")).cast("long").alias("doc_id"), ngram_join.text_hash(_of(docs, "text")).alias("text_hash")]
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("d.text_hash").eqNullSafe(F.col("k.text_hash"))
    rows = rows.select(*key, "*").alias("d").join(kept.alias("k"), same).select("d.*", "k.n")
    repeated = rows.filter("n > 1").dropDuplicates(["doc_id", "text_hash"])
    return rows.filter("n = 1").union(repeated).drop("doc_id", "text_hash", "n").toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their lengths counted anew."""
    weights = pii.train(docs)
    rows, text = _numbered(docs), _of(docs, "text")
    found = pii.detect(rows, weights, text=text, keep=[c for c in rows.columns if c != text])
    found = found.withColumn(text, F.col("masked"))
    if "n_chars" in docs.columns:
        n_chars = _of(docs, "n_chars")
        found = found.withColumn(n_chars, F.coalesce(F.length("masked").cast("long"), F.col(n_chars)))
    return found.select(*rows.columns).toDF(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    hashed = docs.select("doc_id", "text", "source", ngram_join.text_hash("text").alias("text_hash"))
    mixed = mixing.mix(hashed, keep=["doc_id", "text_hash"])
    copies = mixed.groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    copies = stored(copies.filter("copies > 0"), "mixture-copies")
    rows = _numbered(docs).withColumn("text_hash", ngram_join.text_hash(_of(docs, "text")))
    same = F.col(f"d.{_of(docs, 'doc_id')}").eqNullSafe(F.col("k.doc_id")) & F.col("d.text_hash").eqNullSafe(F.col("k.text_hash"))
    taken = rows.alias("d").join(copies.alias("k"), same).select("d.*", "k.copies", "k.n")
    # Rows that are equal in id and text share their copies: one of them stands for all.
    shared = taken.filter("n > 1").dropDuplicates([_of(docs, "doc_id"), "text_hash"])
    whole = taken.filter("n = 1").union(shared)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return whole.select(*[f"c{k}" for k in range(len(docs.columns))], times).drop("copy").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in the sequences."""
    return packing.pack(docs, vocabulary()).drop("source")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
