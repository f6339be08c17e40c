"""Language-model scores from a log-frequency Bloom filter.

Chunks. Each task turns its texts into 64-bit word hashes and stores them about a million tokens at a time: the
distinct hashes, and per token its place among them, compressed. Everything after reads these chunks.

Counting. Per chunk the distinct words and word pairs, with how often its training texts have them, are sent as
sorted arrays to their segments, which are cut by the first bits of the key. One group per segment adds them up, so
counts cover all training tokens and grow with them. The number of segments follows the number of tokens, so that a
group holds at most the parts of about a million tokens, and one part per chunk of a key that is in all chunks: no key
is sent more than once a chunk, so a frequent one needs no salt.

Filter. A count ``c`` of a pair is stored as level ``1 + floor(log2 c)``: (key, 1) to (key, level) are put into the
segment's bit array. A lookup probes level after level until one is missing, so an error can only raise a count by
a level or two. A segment has about eight bits per stored level, however many there are: the share of bits set, and
with it the share of errors, is the same at any size of corpus. ``filter_fill`` reports it. Segments are
nowhere gathered: each group looks up the pairs it was sent in the filter, their words in the exact counts, and the
answers return to the chunks.

Scores. ``score`` adds log10 of ``(c(v w) + M p(w)) / (c(v) + M)`` with ``p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))``,
``c(v w)`` from the filter and at most ``c(v)``. ``base_score`` adds log10 of ``p(w)``. Counts of words are exact.

A word is a run of bytes other than space and 0x09-0x0D, A-Z in lower case; an end token follows each text and
starts the next as context. Words are identified by 64-bit hashes.

Edge cases: null and empty texts have one token, the end; a row without an id is a training row of the query; rows
that repeat count and are scored each; without training rows N and V are 0 and every token has probability 1;
an empty table stays empty. Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.store import stored

SEGMENTS = 256  # at least
TOKENS_A_SEGMENT = 1 << 20
BITS_PER_ENTRY = 8
PROBES = 2
LEVELS = 40
WEIGHT = 10.0
CACHED = 500_000
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))  # no word holds a space
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
TOKENS_AT_ONCE = 1_000_000
KEYS_AT_ONCE = 1 << 18


class Words:
    """Hashes of a text's words, the end last; a bounded cache per worker."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        out[-1] = END
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every number."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    return (x ^ (x >> np.uint64(27))) * MIX1


def pair_keys(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys of each token with the one before; at ``starts`` of texts that is the end token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = END
    return mixed(before * MIX1 + tokens)


def in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[np.ndarray]]]:
    """Ids, training marks and hashed texts of a task's rows, about a million tokens at a time."""
    words = Words()
    ids, marks, texts, held = [], [], [], 0
    for batch in batches:
        for own, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            ids.append(own)
            marks.append(mark)
            texts.append(words(text.as_py()))
            held += len(texts[-1])
            if held >= TOKENS_AT_ONCE:
                yield ids, marks, texts
                ids, marks, texts, held = [], [], [], 0
    if texts:
        yield ids, marks, texts


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bit_places(keys: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> list[np.ndarray]:
    """Bits of (key, level) inside a segment of ``bits`` bits."""
    h = mixed(keys + np.asarray(level).astype(np.uint64) * MIX2)
    step = (h >> np.uint64(32)) | np.uint64(1)
    bits = np.asarray(bits).astype(np.uint64)
    return [((h & np.uint64(0xFFFFFFFF)) + np.uint64(p) * step) % bits for p in range(PROBES)]


def build_segment(keys: np.ndarray, counts: np.ndarray, most_bits: int | None = None) -> tuple[int, np.ndarray]:
    """Number of bits and bit array of one segment; the bits follow the stored levels unless a caller bounds them."""
    levels = 1 + np.floor(np.log2(counts)).astype(np.int64)
    bits = max(64, -(-int(levels.sum()) * BITS_PER_ENTRY // 64) * 64)
    bits = bits if most_bits is None else min(most_bits, bits)
    array = np.zeros(bits // 8, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in bit_places(keys[levels >= level], level, bits):
            np.bitwise_or.at(array, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits, array


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of each count class, 0 for level 0."""
    low = 2.0 ** (level.astype(np.int64) - 1)
    return np.where(level > 0, np.sqrt(low * (2 * low - 1)), 0.0)


class Filter:
    """Segments one after another, the first of them number ``start``."""

    def __init__(self, bits: np.ndarray, data: np.ndarray, shift: int, start: int = 0) -> None:
        self.bits, self.data, self.shift, self.start = bits.astype(np.uint64), data, np.uint64(shift), start
        self.first = np.r_[0, np.cumsum(bits // 8)[:-1]].astype(np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key, 0 if it is not there."""
        level = np.zeros(len(keys), np.uint8)
        for begin in range(0, len(keys), KEYS_AT_ONCE):
            left = np.arange(begin, min(begin + KEYS_AT_ONCE, len(keys)))
            for k in range(1, LEVELS):
                own = keys[left]
                segment = (own >> self.shift).astype(np.int64) - self.start
                bits, first = self.bits[segment], self.first[segment]
                there = bits > 0
                for at in bit_places(own, k, np.maximum(bits, 1)):
                    byte = self.data[np.minimum(first + (at >> np.uint64(3)).astype(np.int64), len(self.data) - 1)]
                    there &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
                left = left[there]
                if not len(left):
                    break
                level[left] = k
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The middle of each key's count class, 0 if it is not there."""
        return middle(self.levels(keys))


def stored_chunks(docs: DataFrame, training: Column, id_col: str, text: str) -> DataFrame:
    """All texts as chunks of hashes: a number, ids, training marks and lengths of the texts, words and places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (ids, marks, texts) in enumerate(in_chunks(batches)):
            words, place = np.unique(np.concatenate(texts), return_inverse=True)
            packed = pa.compress(place.astype("<u4").tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 36) + k], pa.int64()), pa.array([len(place)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                    pa.array([marks], pa.list_(pa.bool_())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([words.tobytes()], pa.binary()), pa.array([packed], pa.binary()),
                ],
                names=["chunk", "n_tokens", "ids", "marks", "lengths", "words", "places"],
            )

    schema = "chunk long, n_tokens long, ids array<bigint>, marks array<boolean>, lengths array<bigint>, words binary, places binary"
    mark = F.coalesce(training, F.lit(False))
    return stored(docs.select(F.col(id_col).cast("long"), mark, F.col(text).cast("string")).mapInArrow(run, schema), "lm-chunks")


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a chunk, the place of each token among them, the keys of pairs, the lengths of texts."""
    words, lengths = np.frombuffer(row["words"], np.uint64), np.array(row["lengths"], np.int64)
    place = np.frombuffer(pa.decompress(row["places"], 4 * int(lengths.sum()), codec="zstd", asbytes=True), "<u4").astype(np.int64)
    return words, place, pair_keys(words[place], np.r_[0, np.cumsum(lengths)[:-1]]), lengths


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Chunks one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def cut(keys: np.ndarray, segments: int) -> list[tuple[int, int]]:
    """From and to of each segment in sorted keys."""
    first = np.arange(segments, dtype=np.uint64) << np.uint64(shift_of(segments))
    cuts = np.searchsorted(keys, first).tolist() + [len(keys)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def segments_for(tokens: int) -> int:
    """A power of two: a segment meets the keys of about ``TOKENS_A_SEGMENT`` tokens or fewer, however many there are."""
    return max(SEGMENTS, 1 << (-(-tokens // TOKENS_A_SEGMENT) - 1).bit_length())


def shift_of(segments: int) -> int:
    """Bits of a key behind the number of its segment."""
    return 64 - (segments.bit_length() - 1)


def answers(chunks: DataFrame, segments: int) -> DataFrame:
    """Per chunk and segment the counts of the chunk's words and the levels of its pairs, in order of their keys.

    One more row per segment, without a chunk, has its training tokens, its training words and the fill of its filter.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, place, keys, lengths = unpacked(row)
            taught = np.repeat(np.array(row["marks"], bool), lengths)
            times = np.bincount(place[taught], minlength=len(words)).astype("<u4")
            pairs, at = np.unique(keys, return_inverse=True)
            pair_times = np.bincount(at[taught], minlength=len(pairs)).astype("<u4")
            out = [
                (row["chunk"], s, words[a:b].tobytes(), times[a:b].tobytes(), pairs[c:d].tobytes(), pair_times[c:d].tobytes())
                for s, ((a, b), (c, d)) in enumerate(zip(cut(words, segments), cut(pairs, segments), strict=True))
                if b > a or d > c
            ]
            names, types = ["chunk", "segment", "words", "times", "pairs", "pair_times"], [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def answer(parts: pa.Table) -> pa.Table:
        def joined(name: str, kind: str) -> tuple[np.ndarray, list[int]]:
            each = parts.column(name).to_pylist()
            return np.frombuffer(b"".join(each), kind), np.cumsum([0, *map(len, each)]).tolist()

        def taught(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return _added(keys[times > 0], times[times > 0].astype(np.int64))

        (words, cuts), (pairs, pair_cuts) = joined("words", "<u8"), joined("pairs", "<u8")
        known, counts = taught(words, joined("times", "<u4")[0])
        bits, data = build_segment(*taught(pairs, joined("pair_times", "<u4")[0]))
        segment = parts.column("segment")[0].as_py()
        levels = Filter(np.array([bits]), data, shift_of(segments), segment).levels(pairs)
        found = np.zeros(len(words), "<i8")
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            found = np.where(known[at] == words, counts[at], 0).astype("<i8")
        slices = lambda x, cuts: [x[a // 8 : b // 8].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        more, one = parts.num_rows, {"tokens": int(counts.sum()), "vocabulary": len(known), "fill": float(np.unpackbits(data).mean()) if data.any() else None}
        return pa.table(
            {
                "chunk": pa.array([*parts.column("chunk").to_pylist(), None], pa.int64()),
                "segment": pa.array([segment] * (more + 1), pa.int32()),
                "counts": pa.array([*slices(found, cuts), None], pa.binary()),
                "levels": pa.array([*slices(levels, pair_cuts), None], pa.binary()),
                "tokens": pa.array([None] * more + [one["tokens"]], pa.int64()),
                "vocabulary": pa.array([None] * more + [one["vocabulary"]], pa.int64()),
                "fill": pa.array([None] * more + [one["fill"]], pa.float64()),
            }
        )

    asked = chunks.select("chunk", "marks", "lengths", "words", "places").mapInArrow(
        ask, "chunk long, segment int, words binary, times binary, pairs binary, pair_times binary"
    )
    schema = "chunk long, segment int, counts binary, levels binary, tokens long, vocabulary long, fill double"
    return stored(asked.groupBy("segment").applyInArrow(answer, schema), "lm-answers")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score and filter_fill of every row; learns from ``training`` rows."""
    chunks = stored_chunks(docs, training, id_col, text)
    segments = segments_for(chunks.agg(F.sum("n_tokens")).first()[0] or 0)
    found = answers(chunks, segments)
    totals = found.agg(F.sum("tokens").alias("n"), F.sum("vocabulary").alias("v"), F.avg("fill").alias("fill")).first()
    n, v, fill = totals.n or 0, totals.v or 0, totals.fill or 0.0

    def rate(own: pa.Table, found: pa.Table) -> pa.Table:
        row = own.select(["lengths", "words", "places"]).to_pylist()[0]
        words, place, keys, lengths = unpacked(row)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        found = found.sort_by("segment")
        counts = np.frombuffer(b"".join(found.column("counts").to_pylist()), "<i8")
        levels = np.frombuffer(b"".join(found.column("levels").to_pylist()), np.uint8)
        c = counts[place]
        p = (c + 0.5) / (n + 0.5 * (v + 1))
        context = np.empty(len(c))
        context[1:], context[starts] = c[:-1], counts[np.searchsorted(words, END)]  # every text has an end
        together = np.minimum(middle(levels)[np.unique(keys, return_inverse=True)[1]], context)
        sums = lambda x: np.add.reduceat(x, starts)
        arrays = [own.column("ids").combine_chunks().flatten(), lengths, sums((c > 0).astype(np.int64)), sums(np.log10(p))]
        arrays.append(sums(np.log10((together + WEIGHT * p) / (context + WEIGHT))))
        return pa.table([pa.array(x) for x in arrays], names=["id", "n_tokens", "n_known", "base_score", "score"])

    own = chunks.select("chunk", "ids", "lengths", "words", "places")
    both = own.groupBy("chunk").cogroup(found.filter("chunk is not null").select("chunk", "segment", "counts", "levels").groupBy("chunk"))
    rated = both.applyInArrow(rate, "id long, n_tokens long, n_known long, base_score double, score double")
    return rated.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.lit(float(fill)).alias("filter_fill"),
    )
