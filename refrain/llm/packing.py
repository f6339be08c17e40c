"""Mixture-controlled packing of documents into fixed windows.

Every source is a queue of tokens. A window of ``window`` sequences serves each queue its share of all tokens:
the deficit of a queue, what it was served too little so far, carries over to the next window and is never one
token or more, so every window holds the proportions of the whole. With pieces cut freely this deficit
round-robin has a closed form: after ``k`` windows the queues up to ``s`` in order have been served
``floor(k * W * A_s / T)`` tokens, with ``A_s`` the tokens of these queues and ``T`` of all. So the place of a
document follows from the tokens before it in its queue and no task has to see another's state.

The tokens before a document: every task numbers its own rows per source while it tokenizes, a small table of
tokens per task and source gives the starts. Texts are tokenized once and their ids never shuffled.

A sequence has ``length`` tokens. What is left at the very end is cut into powers of two, which need no padding.

Words are tokenized one by one, because the tokenizer treats white space only as a border, and kept in a cache
per worker; a word the cache's shortcut does not cover goes to the tokenizer itself. The ids of a slice of texts are
put together from those of its distinct words, and theirs from those of their distinct runs of letters, digits and
runs of marks: so capitals and punctuation make no new words to tokenize.

Edge cases: a null or empty text is its end mark alone; a null source is a queue of its own; rows that repeat
are packed each; an empty table gives no pieces. Columns other than id, source and text are not read.
"""

from __future__ import annotations

import functools
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.store import stored
from refrain.llm.wordcut import slices

# Fixed value: the vocabulary's own split of a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words that are not cut at byte level: with other characters than printable ASCII and letters of two bytes, with the
# beginning of a special token, or with what may be a contraction.
UNCUT = r"[^!-~À-ÖØ-öø-į]|<\||'[DLMRSTVdlmrstv]"
MARK, LETTER, DIGIT = 0, 1, 2
# Kind of every byte of the other words; all bytes beyond ASCII are of letters there.
BY_KIND = np.array([LETTER if b > 127 or chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK for b in range(256)], np.uint8)
CACHED = 600_000
# Bytes of text whose words are looked up together.
SLICE_BYTES = 1_000_000


class WordTokenizer:
    """Ids of texts by a lower-case vocabulary with word ends, one word at a time."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split = regex.compile(PIECES)
        self.words: dict[str, bytes] = {"": b""}
        # Bytes as the vocabulary writes them: printable ones as themselves, the others from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.bytes = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.bytes)
        ids = [t.id for t in self.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable()
        plain = plain or (unicodedata.is_normalized("NFC", word) and word.isprintable() and max(word) < "İ")
        if plain and word.isalpha():
            got = self._piece(word.lower())
        elif plain and "<|" not in word:
            got = b"".join(map(self._piece, self.split.findall(word.lower())))
        else:
            got = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) >= CACHED:
            self.words.clear()
        self.words[word] = got
        return got

    def ids(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit numbers."""
        known = self.words
        return b"".join([known[w] if w in known else self._word(w) for w in text.replace("\n", " ").split(" ")])


@functools.lru_cache(maxsize=1)
def coder_of(vocabulary: str) -> WordTokenizer:
    """One tokenizer and its words per Python worker, which serves many tasks."""
    return WordTokenizer(vocabulary)


def put_together(
    parts: pa.Array, bounds: np.ndarray, spelt: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of rows one after another and the number of ids of each; row k has the parts from ``bounds[k]`` on.

    ``spelt`` gives the same for the distinct parts.
    """
    parts = parts.dictionary_encode()
    pool, sizes = spelt(parts.dictionary)
    number = parts.indices.to_numpy()
    width = sizes[number]
    ends = np.cumsum(width)
    # Position of each id in the pool: its part's start there, and its place in the part.
    shift = (np.cumsum(sizes) - sizes)[number] - (ends - width)
    ids = pool[np.repeat(shift, width) + np.arange(ends[-1] if len(ends) else 0)]
    return ids, np.diff(np.concatenate([[0], ends])[bounds])


def word_parts(words: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters, digits and runs of marks of all words, A-Z lower-cased, and the bounds of the words in them.

    The ids of a word are those of its parts, each tokenized as a word; a word not to be cut is a part as it stands.
    """
    uncut = pc.match_substring_regex(words, UNCUT)
    words = pc.if_else(uncut, words, pc.ascii_lower(words))
    _, offsets, letters = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    body = np.frombuffer(letters or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    kind = BY_KIND[body]
    cut = np.ones(len(body) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    whole = uncut.to_numpy(zero_copy_only=False)
    cut[:-1][np.repeat(whole, np.diff(ends))] = False
    cut[ends] = True
    starts = np.flatnonzero(cut)
    parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(body))
    return parts, np.searchsorted(starts, ends)


def token_ids(texts: pa.Array, coder: WordTokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and the number of ids of each; a null text has none."""
    known = coder.words

    def looked_up(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        spelt = [known.get(p) or coder.ids(p) for p in parts.to_numpy(zero_copy_only=False)]
        return np.frombuffer(b"".join(spelt), "<u4"), np.fromiter(map(len, spelt), np.int64, len(spelt)) // 4

    plain = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " ")
    split = pc.split_pattern(plain, " ")
    offsets = split.offsets.to_numpy()
    return put_together(split.flatten(), offsets - offsets[0], lambda words: put_together(*word_parts(words), looked_up))


def tokenized(docs: DataFrame, id_col: str, source: str, text: str, vocabulary: str, end: int) -> DataFrame:
    """doc_id, source, ids (16-bit), n, part, before: with the tokens before each row in its task and source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, served = coder_of(vocabulary), TaskContext.get().partitionId(), {}
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids, sizes = token_ids(batch.column("text"), coder)
                marked = np.insert(ids.astype("<u2"), np.cumsum(sizes), end)
                lengths, before = sizes + 1, []
                for s, n in zip(batch.column("source").to_pylist(), lengths.tolist(), strict=True):
                    before.append(served.get(s, 0))
                    served[s] = before[-1] + n
                ends = np.concatenate([[0], np.cumsum(2 * lengths)]).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(marked)])
                columns = [
                    batch.column("doc_id"), batch.column("source"), held, pa.array(lengths, pa.int64()),
                    pa.array(np.full(len(sizes), part), pa.int32()), pa.array(before, pa.int64()),
                ]
                yield pa.record_batch(columns, names=["doc_id", "source", "ids", "n", "part", "before"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    schema = "doc_id long, source string, ids binary, n long, part int, before long"
    return stored(rows.mapInArrow(run, schema), "packing-ids")


def served(cumulative: int, total: int, window: int, k: int) -> int:
    """Tokens that queues with ``cumulative`` tokens together have been served after ``k`` windows."""
    return min(k * window, total) * cumulative // total


def pieces_of(start: int, n: int, low: int, high: int, total: int, window: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(offset in the document, tokens, sequence, offset there) of a document's pieces.

    ``start``: tokens before it in its queue, whose tokens are number ``low`` to ``high`` of all in queue order.
    """
    own, done = high - low, 0
    k = min(start * total // (own * window), (total - 1) // window)
    taken = lambda w: served(high, total, window, w) - served(low, total, window, w)
    while done < n:
        at = start + done
        while taken(k) > at:
            k -= 1
        while taken(k + 1) <= at:
            k += 1
        ahead = served(low, total, window, k + 1) - served(low, total, window, k)
        first = k * window + ahead + at - taken(k)
        left = min(n - done, taken(k + 1) - at)
        while left:
            sequence, offset, room = place(first, total, length)
            piece = min(left, room)
            yield done, piece, sequence, offset
            done, first, left = done + piece, first + piece, left - piece


def place(position: int, total: int, length: int) -> tuple[int, int, int]:
    """Sequence, offset in it and room from there, of a position among all tokens."""
    full, rest = divmod(total, length)
    if position < full * length:
        return position // length, position % length, length - position % length
    offset, number = position - full * length, full
    while True:  # the rest in powers of two, the largest first
        size = 1 << (rest.bit_length() - 1)
        if offset < size:
            return number, offset, size - offset
        offset, rest, number = offset - size, rest - size, number + 1


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    length: int = 4096,
    window: int = 32,
    end: int = 2,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, source, sequence_id, offset."""
    rows = tokenized(docs, id_col, source, text, vocabulary, end)
    sums = stored(rows.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-sums")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    queues = sums.groupBy("source").agg(F.sum("n").alias("n"))
    in_order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    queues = queues.select(
        "source",
        (F.sum("n").over(in_order) - F.col("n")).alias("low"),
        F.sum("n").over(in_order).alias("high"),
        F.sum("n").over(all_rows).alias("total"),
    )
    starts = stored(
        starts.alias("s")
        .join(queues.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source")))
        .select("s.*", "low", "high", "total"),
        "packing-starts",
    )
    placed = (
        rows.alias("r")
        .join(starts.alias("s"), (F.col("r.part") == F.col("s.part")) & F.col("r.source").eqNullSafe(F.col("s.source")))
        .select("r.doc_id", "r.source", "r.ids", "r.n", (F.col("before") + F.col("first")).alias("at"), "low", "high", "total")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64(), pa.string(), *[pa.int64()] * 6]
        for batch in batches:
            out = []
            for doc, src, ids, n, at, low, high, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                for start, size, sequence, offset in pieces_of(at, n, low, high, total, window * length, length):
                    crc = zlib.crc32(wide[start : start + size].tobytes())
                    out.append((doc, src, start, size, crc, n, sequence, offset))
            if out:
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.record_batch(arrays, names=names)

    return placed.mapInArrow(
        cut, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
