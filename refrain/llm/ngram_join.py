"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles (64-bit hashes, 48 bits kept). Documents with the same set are
one class with a least id and a count, so copies cost one row. Classes are joined as follows.

1. Chosen paths. Every run starts from all classes and splits them on a sampled token that sets share: position
   ``i`` of a MinHash signature stands for the token ``(i, value)``, and two sets share it with the probability
   of their Jaccard similarity. A bucket with at most ``bucket`` classes is searched by brute force; a larger one
   is split again on ``branch`` newly sampled tokens, so that passages that many documents share fall apart. A
   bucket that a split leaves nearly whole holds a group of near copies: all its members become one candidate group,
   a row each. Large buckets of the last split that are neither are dealt into blocks and every pair of blocks is
   searched. Runs repeat until a pair at the threshold is met with probability ``recall``.
2. Brute force compares signatures and keeps links of likely pairs, as a forest: at most one row per class and
   bucket. Their components are candidate groups.
3. The sets of classes in a group are made again from one text of each and compared exactly, in blocks of
   ``block`` classes, every pair of blocks in a task of its own. Every pair is met in exactly one task, so links
   are counted exactly, without rows for pairs. Sets are never stored: they are larger than the texts' files.

Joins with tables that grow with the input are merge joins at every size; nothing that grows is broadcast.
Only signatures of classes that share a bucket are shuffled, and sets of classes that are in a candidate group.

Edge cases: a null or empty text has no shingle and links with nothing; a text of one to four words has its words
as its only shingle; of rows with equal sets the least id that is not null names the class; null ids come back
as rows with the class of their text; an empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.components import components
from refrain.llm.store import stored

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BUCKET = 256
BLOCK = 512
BRANCH = 2
DEPTH = 5
POSITIONS = 64
KEPT_SHARE = 0.6  # of its members that a split leaves together in a bucket of near copies
LIKELY = 35  # of 64 equal positions: five standard deviations below the mean at a similarity of 0.8
CACHED = 50_000  # words a worker keeps; workers stay from stage to stage, and their memory with them
SET_BYTES = 6
RNG = np.random.default_rng(7)
FACTORS = (RNG.integers(1, 1 << 63, POSITIONS, np.uint64) << np.uint64(1)) | np.uint64(1)
SHIFTS = RNG.integers(0, 1 << 63, POSITIONS, np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted distinct shingle hashes of a text; word hashes are kept in a bounded cache."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        width = min(WORDS, len(h))
        out = np.full(len(h) - width + 1, np.uint64(width))
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * STEP
            out ^= out >> np.uint64(29)
        return np.unique(out >> np.uint64(64 - 8 * SET_BYTES))


def packed(shingles: np.ndarray) -> bytes:
    """48 bits of every hash."""
    return np.ascontiguousarray(shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    out[:, :SET_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, SET_BYTES)
    return out.view("<u8").ravel()


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, one per position."""
    if not len(shingles):
        return np.zeros(POSITIONS, np.int32)
    best = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * FACTORS + SHIFTS
        part ^= part >> np.uint64(31)
        best = np.minimum(best, (part * STEP).min(0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def text_hash(text: str) -> Column:
    """What tells rows with one id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def digest(shingles: np.ndarray) -> bytes | None:
    """What names a set; None for no shingle."""
    return hashlib.blake2b(packed(shingles), digest_size=16).digest() if len(shingles) else None


def slim(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, text and hash of the text."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"), text_hash(text).alias("text_hash"))


def with_signatures(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, hash of the text, digest and signature of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                sets = [shingles(t.as_py()) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        b.column(2),
                        pa.array([digest(s) for s in sets], pa.binary()),
                        pa.array([signature(s).tolist() for s in sets], pa.list_(pa.int32())),
                    ],
                    names=["id", "text_hash", "digest", "sig"],
                )

    return stored(slim(docs, id_col, text).mapInArrow(run, "id long, text_hash long, digest binary, sig array<int>"), "join-signatures")


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold is missed with a probability of at most ``1 - recall``."""
    met = threshold * (1 - (1 - threshold) ** BRANCH) ** (depth - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def _salted(rows: DataFrame, n: str, size: int, tie: str) -> DataFrame:
    """Rows of each key dealt into blocks of about ``size`` and given once to every pair of blocks they belong to.

    Adds x and y, the blocks of a pair with x <= y, and mine, the block of the row. The number of blocks is a power
    of two and the block follows from ``tie`` alone, so a group that several buckets hold is cut alike in all.
    """
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col(n) / size, F.lit(1.0))))).cast("int")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64(tie), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    return rows.withColumn("other", other).select(
        *[c for c in rows.columns], F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")
    )


def _forest(pairs: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """The least member of each component of a small graph."""
    root = np.arange(n)
    a, b = pairs
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _likely_in(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likely pairs of one bucket."""
    a_all, b_all, n = [], [], len(sig)
    for at in range(0, n, 64):
        equal = np.zeros((min(64, n - at), n), np.int16)
        for p in range(POSITIONS):
            equal += sig[at : at + 64, p, None] == sig[None, :, p]
        a, b = np.nonzero(equal >= LIKELY)
        a += at
        a_all.append(a[a < b])
        b_all.append(b[a < b])
    return np.concatenate(a_all), np.concatenate(b_all)


def _roots_in(sig: np.ndarray, mine: np.ndarray, cross: bool) -> np.ndarray:
    """The member that each member of one bucket hangs on: itself, or the least one linked with it by likely pairs.

    In a bucket of two blocks only the roots of each block's own links are hung on others: their members hang on them
    already, by the task that has the block alone. So a group of near copies gives a row per member and block, and one
    per pair of blocks.
    """
    pairs, n = _likely_in(sig), len(sig)
    root = _forest(pairs, n)
    if cross:
        within = mine[pairs[0]] == mine[pairs[1]]
        own = _forest((pairs[0][within], pairs[1][within]), n)
        root = np.where(own == np.arange(n), root, np.arange(n))
    return root


def _likely_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of buckets that arrive one after another: bucket, mine, cross, digest, signature in order.

    Buckets of a few members and one block are compared all at once, the others one by one; the last bucket of a batch
    waits for its rest, and no bucket is longer than two blocks.
    """
    held = None
    small = 8

    def edges(t: pa.Table) -> pa.RecordBatch:
        n = len(t)
        keys = [t.column(c).to_numpy() for c in ("node", "x", "y")]
        change = np.zeros(n, bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        first = np.flatnonzero(change)
        sizes = np.diff(np.r_[first, n])
        group = np.repeat(np.arange(len(first)), sizes)
        sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(n, POSITIONS)
        mine, cross = t.column("mine").to_numpy(), keys[1] != keys[2]
        a_all, b_all, few = [], [], (sizes[group] <= small) & ~cross
        for k in range(1, min(small, n)):
            a = np.flatnonzero(few[:-k] & (group[:-k] == group[k:]))
            a = a[(sig[a] == sig[a + k]).sum(1) >= LIKELY]
            a_all.append(a)
            b_all.append(a + k)
        none = np.zeros(0, np.int64)
        root = _forest((np.concatenate([none, *a_all]), np.concatenate([none, *b_all])), n)
        whole = (sizes > small) | cross[first]
        for f, size in zip(first[whole], sizes[whole], strict=True):
            own = slice(f, f + size)
            root[own] = f + _roots_in(sig[own], mine[own], bool(cross[f]))
        linked = np.flatnonzero(root != np.arange(n))
        digests = t.column("digest").combine_chunks()
        return pa.record_batch([digests.take(pa.array(linked)), digests.take(pa.array(root[linked]))], names=["a", "b"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        last = held.slice(len(held) - 1).to_pylist()[0]
        same = np.ones(len(held), bool)
        for c in ("node", "x", "y"):
            same &= held.column(c).to_numpy() == last[c]
        cut = len(held) if not same.all() else 0
        if cut:
            cut = int(np.flatnonzero(~same)[-1]) + 1
            yield edges(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and len(held):
        yield edges(held)


def candidates(classes: DataFrame, bucket: int, runs: int) -> DataFrame:
    """Edges (a, b) between digests of likely pairs, found by chosen paths."""

    def child(salt, seed):
        """The token of a node that is sampled by ``seed``, and the node of those that share it."""
        at = F.pmod(F.xxhash64(salt, seed), F.lit(POSITIONS)).cast("int")
        return F.xxhash64(salt, at, F.get("sig", at))

    roots = F.array(*[F.lit(r).cast("long") for r in range(runs)])
    paths = classes.select("digest", "sig", F.explode(roots).alias("run"))
    paths = paths.select("digest", "sig", child(F.col("run"), F.lit(0)).alias("node"), F.lit(None).cast("long").alias("parents"))
    # Signatures are left behind until a bucket is known to be shared.
    first = paths.drop("sig")
    found = None
    for depth in range(1, DEPTH + 1):
        members = (first if depth == 1 else paths).groupBy("node")
        counts = members.agg(F.count("*").alias("n"), F.min("digest").alias("least")).filter("n > 1")
        counts = stored(counts, "join-counts")
        if depth == 1:
            shared = stored(first.join(counts.hint("merge"), "node"), "join-paths")
            shared = shared.join(classes.select("digest", "sig").hint("merge"), "digest")
        else:
            shared = paths.join(counts.hint("merge"), "node")
        shared = stored(shared, "join-shared")
        small = F.col("n") <= bucket
        whole = ~small & F.coalesce(F.col("n") >= KEPT_SHARE * F.col("parents"), F.lit(False))
        last = depth == DEPTH
        # A bucket that a split leaves whole is one candidate group, a row per member.
        stars = shared.filter(whole & (F.col("digest") != F.col("least"))).select(F.col("digest").alias("a"), F.col("least").alias("b"))
        ready = shared.filter(~whole if last else small)
        dealt = _salted(ready.select("digest", "sig", "node", "n"), "n", bucket, "digest")
        dealt = dealt.repartition("node", "x", "y").sortWithinPartitions("node", "x", "y", "digest")
        links = stored(dealt.mapInArrow(_likely_links, "a binary, b binary"), "join-links")
        links = links.union(stars)
        found = links if found is None else found.union(links)
        if last:
            break
        open_rows = shared.filter(~small & ~whole)
        if open_rows.isEmpty():
            break
        branches = F.explode(F.array(*[child(F.col("node"), F.lit(s)) for s in range(1, BRANCH + 1)]))
        paths = stored(open_rows.select("digest", "sig", branches.alias("node"), F.col("n").alias("parents")), "join-paths")
    return found


FILTER_BITS = 1 << 26


def sets_of(members: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """digest and set of each class in ``members``, from the text of the row that stands for it.

    Rows are told by a bit array of fixed size (8 MB) over id and hash of the text, which is broadcast. A few others
    pass and leave in the join that follows; without it the sets of all documents would be made and shuffled.
    """
    at = F.pmod(F.xxhash64("id", "text_hash"), F.lit(FILTER_BITS))
    bits = members.select(F.floor(at / 64).alias("word"), (at % 64).cast("int").alias("bit")).select("word", F.expr("shiftleft(1L, bit)").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            place = batch.column(0).to_numpy()
            own = batch.filter(pa.array((shared.value[place >> 6] >> (place & 63)) & 1 == 1))
            for first in range(0, own.num_rows, 512):
                sets = [shingles(t.as_py()) for t in own.column(1).slice(first, 512)]
                yield pa.record_batch(
                    [pa.array([digest(s) for s in sets], pa.binary()), pa.array([packed(s) for s in sets], pa.binary())],
                    names=["digest", "shingles"],
                )

    rows = slim(docs, id_col, text).select(at.alias("place"), "text")
    # Equal rows are reduced to one before the shuffle.
    sets = rows.mapInArrow(passing, "digest binary, shingles binary").groupBy("digest").agg(F.first("shingles").alias("shingles"))
    return members.join(sets.hint("merge"), "digest")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, times = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = times[place] > 1
    _, place = np.unique(place[keep], return_inverse=True)
    owner, out = owner[keep], np.zeros((n, n), np.float32)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    width, last = 4096, int(place[-1]) + 1 if len(place) else 0
    for at in range(0, last, width):
        a, b = np.searchsorted(place, [at, at + width])
        x = np.zeros((n, min(width, last - at)), np.float32)
        x[owner[a:b], place[a:b] - at] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _exact_links(part: pd.DataFrame) -> pd.DataFrame:
    """Documents linked with each class and the least class of its links, for one pair of blocks."""
    part = part.sort_values("digest")
    sets = [unpacked(x) for x in part["shingles"]]
    sizes = np.array([len(s) for s in sets])
    common = shared_counts(sets)
    union = sizes[:, None] + sizes[None, :] - common
    linked = common * 5 >= union * 4  # 0.8 in whole numbers
    np.fill_diagonal(linked, False)
    mine = part["mine"].to_numpy()
    if part["x"].iloc[0] != part["y"].iloc[0]:
        linked &= mine[:, None] != mine[None, :]
    a, b = np.nonzero(linked)
    root = _forest((a, b), len(sets))
    digests = part["digest"].to_numpy()
    out = pd.DataFrame({"digest": digests, "links": linked @ part["copies"].to_numpy(), "root": digests[root]})
    return out[out["links"] > 0]


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """id, text_hash, class_id (the least id its links reach, itself included) and n_links of every document."""
    return grouped(docs, id_col, text, bucket, block).drop("group")


def grouped(docs: DataFrame, id_col: str = "doc_id", text: str = "text", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """As ``join``, with a group that is the same for all documents that links reach, whatever their ids; null without shingles."""
    rows = with_signatures(docs, id_col, text)
    # The row with the least id that is not null stands for its class.
    least = F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("least")
    classes = rows.filter("digest is not null").groupBy("digest").agg(least, F.count("*").alias("copies"), F.first("sig").alias("sig"))
    classes = stored(classes.select("digest", "least.id", "least.text_hash", "copies", "sig"), "join-classes")
    groups = components(candidates(classes, bucket, runs_needed()), "join-groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    members = groups.join(sizes, "component").withColumnRenamed("node", "digest")
    members = stored(members.join(classes.select("digest", "id", "text_hash", "copies"), "digest"), "join-members")
    dealt = _salted(sets_of(members, docs, id_col, text).drop("id", "text_hash"), "n", block, "digest")
    found = stored(
        dealt.groupBy("component", "x", "y").applyInPandas(_exact_links, "digest binary, links long, root binary"), "join-exact"
    )
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")), "join-classes")
    named = reached.join(classes.select(F.col("digest").alias("node"), "id"), "node")
    least = named.groupBy("component").agg(F.min("id").alias("class_id"))
    of_class = stored(
        classes.select("digest", "id", "copies")
        .join(links, "digest", "left")
        .join(reached.withColumnRenamed("node", "digest"), "digest", "left")
        .join(least, "component", "left")
        .select(
            "digest",
            F.coalesce("component", "digest").alias("group"),
            F.coalesce("class_id", "id").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "join-result",
    )
    return rows.select("id", "text_hash", "digest").join(of_class.hint("merge"), "digest", "left").select(
        F.col("id").alias(id_col), "text_hash", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "group"
    )
