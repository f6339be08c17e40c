"""Analytics on part-of-speech annotated tokens.

Windows here are keyed by sentence, which one text bounds, or cut into blocks of sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.operators.ordered import with_previous
from refrain.operators.ranking import topk
from refrain.session import pin

SENTENCE = ["doc_id", "paragraph_id", "sentence_id"]
SENTENCES_PER_BLOCK = 1_000


def prepare_annotated(ann: DataFrame, songs: DataFrame, key: str = "lyrics_id") -> DataFrame:
    """Tokens without punctuation, with the number out of ``docN`` as key and the song's attributes."""
    numbered = ann.filter(F.col("upos") != "PUNCT").withColumn(
        key, F.regexp_replace("doc_id", "doc", "").try_cast("bigint")
    )
    return numbered.join(songs, key, "left")


def top_lemmas(ann: DataFrame, upos: str, by: list[str], k: int, index: str | None = None) -> DataFrame:
    """The ``k`` most frequent lemmas of one word class, overall or per group."""
    counts = ann.filter(F.col("upos") == upos).groupBy(*by, "lemma").agg(F.count("*").alias("n"))
    if not by:
        return counts.orderBy(F.desc("n"), "lemma").limit(k)
    return topk(counts, by, "n", k, ["lemma"], index=index)


def dependency_pairs(
    ann: DataFrame, rel: str = "nsubj", upos: str = "NOUN", head_upos: str = "ADJ"
) -> DataFrame:
    """Counts of "head word" phrases where a word of one class depends on a head of another.

    Both sides are filtered before they meet; a token without such a head would drop out anyway.
    """
    word = ann.filter((F.col("dep_rel") == rel) & (F.col("upos") == upos)).select(
        *SENTENCE, F.col("head_token_id").alias("token_id"), F.col("lemma").alias("_word")
    )
    head = ann.filter(F.col("upos") == head_upos).select(*SENTENCE, "token_id", F.col("lemma").alias("_head"))
    phrase = F.concat_ws(" ", "_head", "_word").alias("term")
    return word.join(head, [*SENTENCE, "token_id"]).groupBy(phrase).agg(F.count("*").alias("n"))


def cooccurrence(ann: DataFrame, relevant: Column, skipgram: int = 0) -> DataFrame:
    """How often two relevant lemmas follow each other in a document: ``(term1, term2, cooc)``.

    ``skipgram`` also pairs words with up to that many others between them. Documents are handled in
    blocks of sentences, so a very long one spreads over tasks.
    """
    order = ["paragraph_id", "sentence_id", "token_id"]
    block = F.struct("paragraph_id", F.floor(F.col("sentence_id") / SENTENCES_PER_BLOCK).alias("part"))
    tok = ann.select("doc_id", *order, F.when(relevant, F.col("lemma")).alias("_0"))
    for step in range(skipgram + 1):
        tok = with_previous(tok, ["doc_id"], order, F.col(f"_{step}"), f"_{step + 1}", block)
    counts = None
    for step in range(1, skipgram + 2):
        pairs = tok.filter(F.col("_0").isNotNull() & F.col(f"_{step}").isNotNull())
        found = pairs.groupBy(F.col(f"_{step}").alias("term1"), F.col("_0").alias("term2")).agg(
            F.count("*").alias("cooc")
        )
        counts = found if counts is None else counts.unionByName(found)
    return counts.groupBy("term1", "term2").agg(F.sum("cooc").alias("cooc")) if skipgram else counts


def word_network(cooc: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Edges: the ``k`` most frequent pairs. Nodes: the distinct words at their ends."""
    edges = cooc.orderBy(F.desc("cooc"), "term1", "term2").limit(k)
    ends = edges.select(F.explode(F.array("term1", "term2")).alias("name"))
    return edges, ends.distinct()


def keyword_runs(ann: DataFrame, relevant: Column, term: str, ngram_max: int) -> DataFrame:
    """Maximal runs of relevant neighbours in a sentence, at most ``ngram_max`` long.

    One row per run: the words in order as ``words``.
    """
    kept = ann.filter(relevant).select(*SENTENCE, "token_id", F.col(term).alias("_term"))
    place = F.row_number().over(Window.partitionBy(*SENTENCE).orderBy("token_id"))
    islands = kept.withColumn("_island", F.col("token_id") - place)
    entry = F.struct("token_id", "_term")
    runs = islands.groupBy(*SENTENCE, "_island").agg(F.sort_array(F.collect_list(entry)).alias("_run"))
    return runs.filter(F.size("_run") <= ngram_max).select(F.col("_run._term").alias("words"))


def rake_keywords(
    ann: DataFrame,
    relevant: Column,
    term: str = "token",
    ngram_max: int = 4,
    min_freq: int = 50,
    degree: str = "with_self",
) -> DataFrame:
    """Keyword phrases after Rose et al. (2010): ``(keyword, ngram, freq, rake)``, freq above ``min_freq``.

    A word's score is its degree over its frequency, a phrase's score the sum over its words. The
    degree counts the length of every phrase the word is in, or, with ``degree="others"``, only the
    other words. Phrases are counted first, so the scoring works on distinct phrases; they are written once, since the
    words' scores and the frequent phrases both read them.
    """
    if degree not in ("with_self", "others"):
        raise ValueError(f"degree must be 'with_self' or 'others', not {degree!r}")
    phrases = keyword_runs(ann, relevant, term, ngram_max).groupBy("words").agg(F.count("*").alias("freq"))
    phrases = pin(phrases.withColumn("ngram", F.size("words")))
    reach = F.col("ngram") - (1 if degree == "others" else 0)
    scores = (
        phrases.select(F.explode("words").alias("_word"), "freq", reach.alias("_reach"))
        .groupBy("_word")
        .agg((F.sum(F.col("freq") * F.col("_reach")).cast("double") / F.sum("freq").cast("double")).alias("_score"))
    )
    frequent = phrases.filter(F.col("freq") > min_freq)
    keyword = F.concat_ws(" ", "words").alias("keyword")
    return (
        frequent.select(keyword, "ngram", "freq", F.explode("words").alias("_word"))
        .join(scores, "_word")
        .groupBy("keyword", "ngram", "freq")
        .agg(F.sum("_score").alias("rake"))
    )
