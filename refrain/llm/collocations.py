"""Collocations of two and three words, mined with stripes.

Words are lower-cased (A-Z) and lie in pieces, which end at punctuation and line ends. Everything is counted per
language.

1. Words are counted per (language, word), combined per slice of texts before the shuffle. A word's code is the
   64-bit hash of both.
2. Stripes. Every prefix of two words keys a counter of the words that follow it, the end of the piece included.
   A slice of texts makes one stripe per prefix; stripes that hash to one bucket travel as one row. In its bucket
   a prefix meets all its stripes and they are merged elementwise, a bounded number of entries at a time. The
   merged stripe states three things: the counts of the extensions (three words), their sum, which is the count
   of the prefix (two words), and their greatest, which tells whether a longer phrase subsumes the prefix.
   ``buckets`` follows from the number of words, so that a bucket has the same size in every corpus.
3. A prefix whose two words both make up at least one word in ``HEAVY`` (at most ``HEAVY`` words are that frequent)
   may be as frequent as a whole bucket: its stripes are cut by the next word's code into ``SLICES`` buckets, and
   its partial sums and maxima are added up afterwards.
4. Only phrases with at least ``least`` occurrences leave the buckets. All parts of a candidate are as frequent as
   itself, so nothing else is needed: scores, cuts and subsumption are joins of these rows with the words.

Edge cases: null and empty texts have no words; a null language is ``und``; ids are not read, so repeated rows count
each; ties are broken by count and phrase; an empty table gives no rows. Columns other than language and text are not
read. Words are told apart by their codes: of a billion words two share one with a probability of 0.03.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.store import stored
from refrain.llm.wordcut import BY_PIECES, slices, words_of

SLICE_BYTES = 4_000_000
WORDS_A_BUCKET = 2_000_000
HEAVY = 256
SLICES = 64
END = 0  # the code of "no next word in this piece"
POSITIONS = (1 << 21) - 4  # word numbers of one step fit 21 bits
PENDING = 2_000_000
SEED = 42  # Fixed value: what Spark's xxhash64 starts from.


def _coded(batch: pa.RecordBatch) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, list[str]]:
    """Words, their pieces, the language number of each, and the languages."""
    words, text, piece = words_of(batch.column("text"), BY_PIECES, lower=True)
    langs = batch.column("lang").dictionary_encode()
    return words.dictionary_encode(), piece, langs.indices.to_numpy(zero_copy_only=False)[text], langs.dictionary.to_pylist()


def _distinct(words: pa.DictionaryArray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language and dictionary number of each distinct word, its count, and the distinct word of each position."""
    size = max(len(words.dictionary), 1)
    keys, at, counts = np.unique(lang.astype(np.int64) * size + words.indices.to_numpy(), return_inverse=True, return_counts=True)
    return keys // size, keys % size, counts, at


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, word, n: the occurrences of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                words, _, lang_of, langs = _coded(batch)
                lang_no, word_no, n, _ = _distinct(words, lang_of)
                yield pa.record_batch(
                    [
                        pa.array(langs, pa.string()).take(pa.array(lang_no)),
                        words.dictionary.take(pa.array(word_no)).cast(pa.large_string()).cast(pa.string()),
                        pa.array(n, pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    rows = _texts(docs, lang, text).mapInArrow(count, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def _bucket(first: np.ndarray, second: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a prefix, and of a part of its stripe."""
    mixed = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _is_heavy(codes: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    return np.isin(codes, heavy) if len(heavy) else np.zeros(len(codes), bool)


def _counted(codes: np.ndarray, piece: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """First, second, third and count of the distinct triples, in order of their codes, ``POSITIONS`` words at a time."""
    for low in range(0, len(codes), POSITIONS):
        high = min(low + POSITIONS, len(codes))
        known, number = np.unique(codes[low : high + 2], return_inverse=True)
        number, known = number.astype(np.int64) + 1, np.concatenate([[END], known]).astype(np.int64)
        own, near = number[: high - low], piece[low : high + 2]
        key = own << 42
        for ahead, shift in ((1, 21), (2, 0)):
            n = min(high - low, len(number) - ahead)
            if n > 0:
                key[:n] |= np.where(near[ahead : ahead + n] == near[:n], number[ahead : ahead + n], 0) << shift
        key, count = np.unique(key, return_counts=True)
        mask = (1 << 21) - 1
        yield known[key >> 42], known[(key >> 21) & mask], known[key & mask], count


STRIPES = "bucket int, first binary, second binary, width binary, next binary, count binary"


def stripes(docs: DataFrame, buckets: int, heavy: list[int], lang: str = "lang", text: str = "text") -> DataFrame:
    """One row per slice of texts and bucket: prefixes, the widths of their stripes, and the next words with counts."""
    frequent = np.array(sorted(heavy), np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                words, piece, lang_of, langs = _coded(batch)
                seeds = [xxhash.xxh64_intdigest(x.encode(), SEED) for x in langs]
                lang_no, word_no, _, at = _distinct(words, lang_of)
                spelt = words.dictionary.to_pylist()
                code = [xxhash.xxh64_intdigest(spelt[w], seeds[s]) for s, w in zip(lang_no.tolist(), word_no.tolist(), strict=True)]
                codes = np.array(code, np.uint64).view(np.int64)[at] if len(at) else np.zeros(0, np.int64)
                for first, second, third, count in _counted(codes, piece):
                    rows = _packed(first, second, third, count, buckets, frequent)
                    yield pa.record_batch(
                        [pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))],
                        names=["bucket", "first", "second", "width", "next", "count"],
                    )

    return _texts(docs, lang, text).mapInArrow(cut, STRIPES)


def _packed(
    first: np.ndarray, second: np.ndarray, third: np.ndarray, count: np.ndarray, buckets: int, heavy: np.ndarray
) -> list[tuple]:
    """A row of bytes for each bucket that occurs; entries keep their order in it."""
    part = np.where(_is_heavy(first, heavy) & _is_heavy(second, heavy), third.view(np.uint64) % np.uint64(SLICES) + np.uint64(1), np.uint64(0))
    bucket = _bucket(first, second, part, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, first, second, third, count = (x[order] for x in (bucket, first, second, third, count))
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
    new = np.ones(len(bucket), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (bucket[1:] != bucket[:-1])
    heads = np.flatnonzero(new)
    width = np.diff(heads, append=len(bucket)).astype("<u4")
    first, second, count = first[heads], second[heads], count.astype("<u4")
    starts = np.searchsorted(heads, edges)
    rows = []
    for k in range(len(edges) - 1):
        of, entry = slice(starts[k], starts[k + 1]), slice(edges[k], edges[k + 1])
        rows.append((int(bucket[edges[k]]), first[of].tobytes(), second[of].tobytes(), width[of].tobytes(), third[entry].tobytes(), count[entry].tobytes()))
    return rows


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Stripes added elementwise: distinct (first, second, next) in order, with their counts."""
    first, second, third, count = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((third, second, first))
    first, second, third, count = first[order], second[order], third[order], count[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])
    heads = np.flatnonzero(new)
    return first[heads], second[heads], third[heads], np.add.reduceat(count, heads)


PHRASES = "first long, second long, third long, n long, longest long"


def frequent_phrases(packed: DataFrame, heavy: list[int], least: int) -> DataFrame:
    """Phrases with at least ``least`` occurrences, from merged stripes.

    ``third`` is 0 for two words; then ``longest`` is the count of the most frequent extension. A prefix that was
    cut comes in parts, of any count.
    """
    frequent = np.array(sorted(heavy), np.int64)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pending, whole = [], 0, 0
        for batch in batches:
            for first, second, width, following, count in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                size = np.frombuffer(width, "<u4")
                of = [np.repeat(np.frombuffer(x, np.int64), size) for x in (first, second)]
                held.append((*of, np.frombuffer(following, np.int64), np.frombuffer(count, "<u4").astype(np.int64)))
                pending += len(held[-1][0])
                if pending > PENDING + whole:  # what is merged already is merged again only when as much has come
                    held = [_merged(held)]
                    whole = pending = len(held[0][0])
        first, second, third, count = _merged(held)
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        heads = np.flatnonzero(new)
        total = np.add.reduceat(count, heads)
        longest = np.maximum.reduceat(np.where(third != END, count, 0), heads)
        cut = _is_heavy(first[heads], frequent) & _is_heavy(second[heads], frequent)
        pairs = heads[keep := (second[heads] != END) & ((total >= least) | cut)]
        triples = np.flatnonzero((third != END) & (count >= least))
        columns = [
            np.concatenate([first[pairs], first[triples]]),
            np.concatenate([second[pairs], second[triples]]),
            np.concatenate([np.full(len(pairs), END), third[triples]]),
            np.concatenate([total[keep], count[triples]]),
            np.concatenate([longest[keep], np.zeros(len(triples), np.int64)]),
        ]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["first", "second", "third", "n", "longest"])

    return packed.groupBy("bucket").applyInArrow(merge, PHRASES)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits."""
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    top = (wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", top, (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 10, share: int = 50, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases.

    A phrase of two words is dropped if some phrase of three that contains it has at least ``share`` percent of its
    occurrences (and ``least``).
    """
    counts = stored(word_counts(docs, lang, text), "collocation-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = 1 << max(0, (total // WORDS_A_BUCKET).bit_length())
    words = counts.filter(F.col("n") >= least).withColumn("code", F.xxhash64("lang", "word"))
    # At most HEAVY rows, because each of these words makes up one in HEAVY of all.
    heavy = [r.code for r in words.filter(F.col("n") * HEAVY >= total).select("code").collect()]
    found = stored(frequent_phrases(stripes(docs, buckets, heavy, lang, text), heavy, least), "collocation-phrases")

    pairs = found.filter(F.col("third") == END).groupBy("first", "second")
    pairs = stored(
        pairs.agg(F.sum("n").alias("a"), F.max("longest").alias("longest")).filter(F.col("a") >= least), "collocation-pairs"
    )
    triples = found.filter(F.col("third") != END).select("first", "second", "third", F.col("n").alias("a"))
    before = triples.groupBy(F.col("second").alias("first"), F.col("third").alias("second")).agg(F.max("a").alias("before"))
    longer = F.greatest("longest", F.coalesce("before", F.lit(0)))
    two = pairs.join(before, ["first", "second"], "left").filter(~((longer >= least) & (100 * longer >= share * F.col("a"))))
    two = two.select("first", "second", F.lit(None).cast("long").alias("third"), "a", F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail"))
    three = triples.join(pairs.select("first", "second", F.col("a").alias("head")), ["first", "second"]).join(
        pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("tail")), ["second", "third"]
    )
    phrases = two.unionByName(three.select(*two.columns))
    named = lambda at, *more: words.select(F.col("code").alias(at), F.col("word").alias(f"{at}_word"), F.col("n").alias(f"{at}_n"), *more)
    phrases = phrases.join(named("first", "lang"), "first").join(named("second"), "second").join(named("third"), "third", "left")
    phrases = phrases.withColumn("rest", F.coalesce("tail", "second_n"))
    one, other = _score("a", "first_n", "rest"), _score("a", "head", "third_n")
    phrases = phrases.select(
        "lang",
        F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"),
        "a",
        F.when(other < one, F.struct(F.col("head").alias("l"), F.col("third_n").alias("r"), other.alias("score")))
        .otherwise(F.struct(F.col("first_n").alias("l"), F.col("rest").alias("r"), one.alias("score")))
        .alias("cut"),
    ).select("lang", "phrase", "a", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
