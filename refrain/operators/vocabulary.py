"""A distributed word index and the sparse vectors built on it.

Words are numbered by Spark and joined to the counts, so a vocabulary is a table: no list of words passes the driver.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refrain.operators.ordered import add_index


def word_index(long: DataFrame, n_docs: Column | None = None, min_share: float = 0.0, word: str = "word") -> DataFrame:
    """Every word that occurs in at least ``min_share`` of the documents: ``(word, docs, place)``.

    ``long`` has one row per document and word. Places run from 0 in the order of the words, and at most (mean distinct
    words of a document) / ``min_share`` words stay, whatever the number of documents.
    """
    docs = long.groupBy(word).agg(F.count("*").alias("docs"))
    if min_share > 0:
        docs = docs.filter(F.col("docs") >= F.lit(float(min_share)) * n_docs)
    return add_index(docs, [word], "_index").select(word, "docs", (F.col("_index") - 1).cast("int").alias("place"))


def sparse_vectors(
    long: DataFrame, index: DataFrame, key: list[str], value: str, word: str = "word", out: str = "features"
) -> DataFrame:
    """One row per document with a Spark ML vector of its values, in the places of the index.

    Words outside the index weigh nothing; a document without any other keeps an empty vector. The index comes from a
    written table, so the join is free to split a frequent word.
    """
    entry = F.when(F.col("place").isNotNull(), F.struct("place", F.col(value).cast("double").alias("value")))
    # The join deals rows by word, so a task holds few rows of each document: to gather them before the shuffle would only
    # sort them once more.
    placed = long.join(index.select(word, "place"), word, "left").select(*key, entry.alias("_entry")).repartition(*key)
    placed = placed.groupBy(*key).agg(F.array_sort(F.collect_list("_entry")).alias("_entries"))
    size = F.lit(index.count()).cast("int")
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        size.alias("size"),
        F.col("_entries.place").alias("indices"),
        F.col("_entries.value").alias("values"),
    )
    shaped = placed.select(*key, parts.alias(out))
    # The struct is a sparse vector already; Spark has no expression that says so, a pass through Arrow does.
    schema = T.StructType([*shaped.schema.fields[:-1], T.StructField(out, VectorUDT())])
    return shaped.mapInArrow(lambda batches: batches, schema)


def vector_entries(df: DataFrame, key: list[str], features: str = "features") -> DataFrame:
    """A vector's size, places and values as plain columns, for reports and comparisons."""

    def unpacked(batches):
        import pyarrow as pa

        for batch in batches:
            vector = batch.column(len(key))
            parts = [vector.field(name) for name in ("size", "indices", "values")]
            yield pa.record_batch([*[batch.column(k) for k in range(len(key))], *parts], names=[*key, "size", "places", "values"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*key).schema.fields]
    return df.select(*key, features).mapInArrow(unpacked, ", ".join([*fields, "size int, places array<int>, values array<double>"]))
