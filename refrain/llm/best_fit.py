"""Best-fit packing of whole documents by exact complements.

Documents are tokenized and only those longer than a sequence are cut, into pieces of a sequence's length; the last
piece may be shorter. What has to be packed is then known by lengths alone: a table of at most ``length`` rows, one
per length with its number of pieces. The plan is made from that table, so its cost does not depend on the corpus.

Plan. A sequence is opened by the longest piece left. Its gap is closed by a combination that fills it exactly: one
piece, two or three, found by the sums of available lengths. Where none does, the longest piece that fits goes in (best
fit) and the smaller gap is tried again. What a sequence holds is repeated as often as the availability counts allow,
which uses up a length, so the rows of the plan are bounded by the lengths, however many pieces there are.

Places. Pieces of one length are numbered: each task numbers its own while it tokenizes, and a table of pieces per task
and length gives the starts. The plan says which numbers of which length go to which sequences, so each piece finds
its place by itself. Neither texts nor ids are shuffled or stored.

Tokens of a text are put together from those of its distinct words, a slice of texts at a time; see
``packing`` for why a text may be tokenized by words.

Edge cases: a null or empty text is its end mark alone; rows that repeat, also with null ids, are packed each; equal
lengths are told apart by their number; an empty table gives no pieces. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.packing import SLICE_BYTES, coder_of, token_ids
from refrain.llm.store import stored
from refrain.llm.wordcut import slices


def numbered_pieces(docs: DataFrame, id_col: str, text: str, vocabulary: str, length: int, end: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, number: with a number of its own in its task and length."""
    mark = np.array([end], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = coder_of(vocabulary), TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids, sizes = token_ids(batch.column("text"), coder)
                out, at = [], 0
                for doc, n in zip(batch.column("doc_id").to_pylist(), sizes.tolist(), strict=True):
                    own = np.concatenate([ids[at : at + n], mark])
                    at += n
                    for piece, start in enumerate(range(0, n + 1, length)):
                        body = own[start : start + length]
                        out.append((doc, piece, start, len(body), zlib.crc32(body.tobytes()), part, int(seen[len(body)])))
                        seen[len(body)] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long")


class Complements:
    """Available lengths and the combinations of one, two or three of them that fill a gap."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.copy()
        self.pairs: dict[int, tuple[int, int]] = {}
        self.known: set[int] = set()

    def has(self, *lengths: int) -> bool:
        return all(self.left[x] >= lengths.count(x) for x in lengths)

    def pair(self, gap: int) -> tuple[int, int] | None:
        """Two lengths that fill ``gap``, the longer one as long as possible. Availability only falls, so a miss stays one."""
        if gap in self.known:
            found = self.pairs.get(gap)
            if found is None or self.has(*found):
                return found
        self.known.add(gap)
        here = np.arange((gap + 1) // 2, gap)
        enough = (self.left[here] > 0) & (self.left[gap - here] > 0)
        if gap % 2 == 0 and len(here):
            enough[0] = self.left[gap // 2] > 1
        fits = np.flatnonzero(enough)
        if len(fits):
            self.pairs[gap] = (int(here[fits[-1]]), gap - int(here[fits[-1]]))
        else:
            self.pairs.pop(gap, None)
        return self.pairs.get(gap)

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """The lengths of a combination that fills ``gap`` exactly."""
        if self.left[gap]:
            return (gap,)
        if (two := self.pair(gap)) is not None:
            return two
        # The longest of three takes at least a third of the gap.
        for longest in np.flatnonzero(self.left[-(-gap // 3) : gap])[::-1] + -(-gap // 3):
            rest = self.pair(gap - int(longest))
            if rest is not None and self.has(int(longest), *rest):
                return (int(longest), *rest)
        return None

    def longest_within(self, gap: int) -> int:
        fits = np.flatnonzero(self.left[1 : gap + 1])
        return int(fits[-1]) + 1 if len(fits) else 0


def plan(counts: np.ndarray, length: int) -> np.ndarray:
    """Rows of (length, first number, first sequence, offset, times): so many pieces of the length, from that number on,
    go to consecutive sequences at the offset. ``counts`` has the pieces of each length.
    """
    stock = Complements(np.asarray(counts, np.int64))
    used = np.zeros(length + 1, np.int64)
    rows, sequences = [], 0
    for opener in range(length, 0, -1):
        while stock.left[opener]:
            held, more, gap = [], (opener,), length
            while more:
                held.extend(more)
                gap -= sum(more)
                np.subtract.at(stock.left, list(more), 1)
                best = stock.longest_within(gap)
                more = (stock.filling(gap) or (best,)) if best else ()
            times = 1 + min(int(stock.left[x]) // held.count(x) for x in set(held))
            np.subtract.at(stock.left, held, times - 1)
            offset = 0
            for x in held:
                rows.append((x, int(used[x]), sequences, offset, times))
                used[x] += times
                offset += x
            sequences += times
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", length: int = 4096, end: int = 1
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(numbered_pieces(docs, id_col, text, vocabulary, length, end), "best-fit-pieces")
    sums = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "best-fit-sums")
    # One row per length at most, whatever the corpus.
    counts = np.zeros(length + 1, np.int64)
    for row in sums.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    places = plan(counts, length)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    keys = (places[:, 0] << 48) | places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (size << 48) | number, side="right") - 1
            sequence = places[at, 2] + number - places[at, 1]
            columns = [batch.column(k) for k in range(5)]
            yield pa.record_batch([*columns, pa.array(sequence), pa.array(places[at, 3])], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    # One row per task and length grows with the corpus: a merge join, never a broadcast.
    ranked = pieces.join(starts.hint("merge"), ["length", "part"]).select(*names, (F.col("first") + F.col("number")).alias("rank"))
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
