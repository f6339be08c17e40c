"""Topic models and their weights as rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain import fixed
from refrain.operators.ranking import topk
from refrain.operators.vocabulary import sparse_vectors, vector_entries, word_index
from refrain.session import discard, stored, sweep

# How fast the online updates of Hoffman et al. (2010) fade, the change of a document's weights that ends
# its updates, and the document-term counts that one group of documents is made for.
LEARNING_OFFSET = 1024
LEARNING_DECAY = 0.51
TOLERANCE = 1e-3
GROUP_ENTRIES = 2_000_000
GROUPS_PER_CORE = 2  # at least, so that no core waits long for the last group
SLICE_ENTRIES = 250_000  # of one packed row
BLOCK_TERMS = 50_000
CHUNK_ENTRIES = 10_000  # so that a chunk of 20 topics stays in the processor cache
EXPECTED_ROWS = 2_000


@dataclass
class TopicModel:
    """Weights of the terms as a table ``(place, w0, w1, …)``, one column per topic, and their sums per topic."""

    weights: DataFrame
    totals: list[float]
    alpha: float
    fitted: tuple | None = None  # the vectors it was fitted on, their groups, and its weights in blocks

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:  # noqa: N802, N803 - named as in Spark ML
        """The heaviest terms of each topic: ``(topic, termIndices, termWeights)``, topics from 0."""
        top = topk(_long(self), ["topic"], "weight", maxTermsPerTopic, ["place"])
        ranked = top.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "place"))).alias("_r"))
        return ranked.select("topic", F.col("_r.place").alias("termIndices"), F.transform("_r.w", lambda w: -w).alias("termWeights"))


def _columns(k: int) -> list[str]:
    return [f"w{i}" for i in range(k)]


def _drawn(index: DataFrame, k: int, seed: int) -> DataFrame:
    """Weights to start from: for each term and topic one draw of a gamma distribution with mean 1 and deviation 0.1.

    The draws are hashes of place, topic and seed, made normal by Box and Muller and skewed by Wilson and Hilferty, so
    they do not depend on how the rows are dealt to tasks.
    """
    def uniform(topic: int, draw: int) -> Column:
        return (F.shiftrightunsigned(F.xxhash64("place", F.lit(topic), F.lit(draw), F.lit(seed)), 11) + 1) / F.lit(2.0**53)

    def weight(topic: int) -> Column:
        normal = F.sqrt(-2 * F.log(uniform(topic, 0))) * F.cos(2 * F.pi() * uniform(topic, 1))
        return F.pow(normal / 30 + (1 - 1 / 900), F.lit(3.0))

    return index.select("place", *[weight(i).alias(c) for i, c in enumerate(_columns(k))])


def _digamma(x: np.ndarray) -> np.ndarray:
    """The digamma function of positive values: six steps of the recurrence, two by two, then the asymptotic series."""
    p, y = x * (x + 5), x + 6
    f = 1 / (y * y)
    return np.log(y) - 0.5 / y - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132)))) - (2 * x + 5) * (1 / p + 1 / (p + 4) + 1 / (p + 6))


def _theta(gamma: np.ndarray) -> np.ndarray:
    """Exponentiated expectations of documents' weights, up to a factor per document, which no update depends on."""
    return np.exp(_digamma(gamma))


def _update(rows: np.ndarray, counts: np.ndarray, gamma: np.ndarray, alpha: float, enough: int) -> np.ndarray:
    """Update the weights of some documents in place until at most ``enough`` of them move on; which these are.

    ``rows`` holds the exponentiated expectations of each entry's term, by document, entry and topic. A document whose
    weights change by less than the tolerance keeps them.
    """
    live, here, heavy, old = np.arange(len(rows)), rows, counts, gamma.copy()
    moving, out = np.ones(len(rows), dtype=bool), np.zeros(len(rows), dtype=bool)
    while True:
        now = _theta(old)
        share = heavy / (np.matmul(here, now[:, :, None])[:, :, 0] + 1e-100)
        new = now * np.matmul(share[:, None, :], here)[:, 0, :] + alpha
        still = moving & (np.abs(new - old).sum(axis=1) > TOLERANCE * new.shape[1])
        ended = moving & ~still
        gamma[live[ended]] = new[ended]
        left, moving, old = np.count_nonzero(still), still, new
        if left <= enough:
            gamma[live[moving]], out[live[moving]] = new[moving], True
            return out
        if left < 0.7 * len(live):
            live, here, heavy, old, moving = live[moving], here[moving], heavy[moving], old[moving], moving[moving]


class _Entries:
    """Entries of a group's documents, one document after another, from the shortest to the longest."""

    def __init__(self, sizes: np.ndarray, at: np.ndarray, counts: np.ndarray):
        self.sizes, self.at, self.counts = sizes, at, counts
        self.first = np.cumsum(sizes) - sizes

    def filled(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Term rows, counts and places by document and entry, short documents filled up with entries of count 0; which
        are real."""
        sizes = self.sizes[some][:, None]
        place = np.arange(sizes.max())
        real = place < sizes
        entry = np.where(real, self.first[some][:, None] + place, 0)
        return self.at[entry], np.where(real, self.counts[entry], 0.0), entry, real

    def upto(self, first: int, more: int = 0) -> int:
        """The end of the documents from ``first`` on that are a chunk together with ``more`` shorter ones; one at least."""
        last = first + 1
        while last < len(self.sizes) and self.sizes[last] * (last + 1 - first + more) <= CHUNK_ENTRIES:
            last += 1
        return last


def _expected(weights: np.ndarray, totals: list[float]) -> np.ndarray:
    """Put the exponentiated expectations of the terms' weights in their place, some rows at a time so that they stay in
    the processor's cache."""
    whole = _digamma(np.array(totals))
    for i in range(0, len(weights), EXPECTED_ROWS):
        weights[i : i + EXPECTED_ROWS] = np.exp(_digamma(weights[i : i + EXPECTED_ROWS]) - whole)
    return weights


def _infer(entries: _Entries, expected: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Variational weights of all documents, and of every entry the count over what these weights expect of its term.

    Most documents settle in a fraction of the updates that the slowest of a chunk need; when a quarter is left these
    join the next chunk, so that no updates are made for a handful of documents.
    """
    n = len(entries.sizes)
    gamma, share = np.ones((n, expected.shape[1])), np.empty(len(entries.at))
    left, first = np.zeros(0, dtype=int), 0
    while first < n or len(left):
        last = entries.upto(first, len(left)) if first < n else n
        some = np.concatenate([left, np.arange(first, last)])
        at, counts, entry, real = entries.filled(some)
        rows, part = np.take(expected, at, axis=0), gamma[some]
        moving = _update(rows, counts, part, alpha, len(some) // 4 if last < n else 0)
        over = counts / (np.matmul(rows, _theta(part)[:, :, None])[:, :, 0] + 1e-100)
        real &= ~moving[:, None]
        share[entry[real]] = over[real]
        gamma[some], left, first = part, some[moving], last
    return gamma, share


def _group_steps(docs, terms, totals: list[float], alpha: float):
    """A group's documents from the shortest to the longest, their entries, the entries' shares and the documents' weights.

    ``terms`` comes in the order of the places.
    """
    if not len(docs):
        return
    docs = docs.iloc[np.argsort(docs["places"].map(len).to_numpy(), kind="stable")]
    at = np.searchsorted(terms["place"].to_numpy(), np.concatenate(docs["places"].to_list()))
    entries = _Entries(docs["places"].map(len).to_numpy(), at, np.concatenate(docs["values"].to_list()))
    gamma, share = _infer(entries, _expected(terms[_columns(len(totals))].to_numpy(dtype=float, copy=True), totals), alpha)
    yield docs, entries, share, gamma


def _added(entries: _Entries, expected: np.ndarray, gamma: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What all documents add to the weights of the terms, one topic at a time, in the place of ``expected``."""
    at = entries.at.astype(np.intp)
    for topic, of_docs in enumerate(_theta(gamma).T.copy()):
        expected[:, topic] *= np.bincount(at, np.repeat(of_docs, entries.sizes) * share, len(expected))
    return expected


@dataclass
class _Groups:
    """Documents in groups of bounded size, packed: ``(g, slice, keys, sizes, at, counts)``, and the rows of each block of
    terms that a group holds: ``(b, g, at)``.

    Term ``place`` is row ``place div blocks`` of block ``place mod blocks``; a group numbers its terms by block and row.
    """

    docs: DataFrame
    held: DataFrame
    blocks: int


def _cells(values: np.ndarray, lengths: list[int]):
    """Consecutive rows of numbers as packed cells, without a copy."""
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(lengths)]) * (values.nbytes // max(1, len(values)))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _ordered(table, by: str, name: str, kind) -> list[np.ndarray]:
    """The numbers of each packed cell, in the order of another column."""
    cells = [np.frombuffer(cell.as_buffer(), kind) for cell in table[name]]
    return [cells[i] for i in np.argsort(table[by].to_numpy())]


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a column of arrays."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten().to_numpy(zero_copy_only=False)


def _grouped(vectors: DataFrame, key: str) -> _Groups:
    """Pack the documents that have terms into groups."""
    import pyarrow as pa

    rows = vector_entries(vectors, [key]).filter(F.size("places") > 0)
    entries, terms = rows.agg(F.sum(F.size("places")), F.max("size")).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-(entries or 0) // GROUP_ENTRIES), GROUPS_PER_CORE * cores)
    terms = terms or 1
    blocks = min(max(-(-terms // BLOCK_TERMS), cores), terms)
    span = -(-terms // blocks)

    def packed(docs):
        sizes, places = _lists(docs["places"])
        values, begin, order = _lists(docs["values"])[1], np.cumsum(sizes) - sizes, np.argsort(sizes, kind="stable")
        keys, sizes = docs["_key"].combine_chunks().take(pa.array(order)), sizes[order]
        entry = np.repeat(begin[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(places))
        places = places[entry].astype(np.int64)
        held, at = np.unique(places % blocks * span + places // blocks, return_inverse=True)
        at, values, ends = at.astype(np.int32), values[entry], np.cumsum(sizes)
        out = {name: [] for name in ("b", "slice", "keys", "sizes", "at", "counts")}
        first = 0
        while first < len(sizes):
            start = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, start + SLICE_ENTRIES, "right")))
            part = slice(start, ends[last - 1])
            row = (None, len(out["b"]), keys[first:last], sizes[first:last].astype(np.int32).tobytes(), at[part].tobytes(), values[part].tobytes())
            for name, cell in zip(out, row, strict=True):
                out[name].append(cell)
            first = last
        edges = np.searchsorted(held, np.arange(blocks + 1) * span)
        for b in range(blocks):
            row = (b, None, None, None, (held[edges[b] : edges[b + 1]] - b * span).astype(np.int32).tobytes(), None)
            for name, cell in zip(out, row, strict=True):
                out[name].append(cell)
        kinds = {"b": pa.int32(), "slice": pa.int32(), "keys": pa.list_(pa.string()), "sizes": pa.binary(), "at": pa.binary(), "counts": pa.binary()}
        lists = [None if c is None else c.to_pylist() for c in out["keys"]]
        columns = {name: pa.array(lists if name == "keys" else out[name], kind) for name, kind in kinds.items()}
        return pa.table({"g": pa.array([docs["g"][0].as_py()] * len(out["b"]), pa.int32()), **columns})

    dealt = rows.select(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("g"), F.col(key).cast("string").alias("_key"), "places", "values")
    schema = "g int, b int, slice int, keys array<string>, sizes binary, at binary, counts binary"
    table, _ = stored(dealt.groupBy("g").applyInArrow(packed, schema), "topic-groups")
    return _Groups(table.filter("b IS NULL").drop("b"), table.filter("b IS NOT NULL").select("b", "g", "at"), blocks)


BLOCK = "b int, weights binary, totals array<double>, groups array<int>, held array<binary>"


def _block(b: int, weights: np.ndarray, groups: list[int], held: list[bytes]):
    """One block as a row: its weights, their sums, and the groups with the rows that they hold."""
    import pyarrow as pa

    kinds = {"b": pa.int32(), "weights": pa.binary(), "totals": pa.list_(pa.float64()), "groups": pa.list_(pa.int32()), "held": pa.list_(pa.binary())}
    cells = (b, weights.tobytes(), weights.sum(axis=0).tolist(), groups, held)
    return pa.table({name: pa.array([cell], kind) for (name, kind), cell in zip(kinds.items(), cells, strict=True)})


def _blocks(weights: DataFrame, groups: _Groups, k: int) -> DataFrame:
    """Rows of weights ``(place, w0, …)``, all places from 0 on, as blocks."""
    n = groups.blocks

    def packed(terms, held):
        order = np.argsort(terms["place"].to_numpy(), kind="stable")
        values = np.column_stack([terms[c].to_numpy()[order] for c in _columns(k)])
        held = held.sort_by("g")
        return _block(terms["b"][0].as_py(), values, held["g"].to_pylist(), held["at"].to_pylist())

    rows = weights.withColumn("b", (F.col("place") % n).cast("int")).groupBy("b")
    return rows.cogroup(groups.held.groupBy("b")).applyInArrow(packed, BLOCK)


def _unpacked(blocks: DataFrame, n: int, k: int) -> DataFrame:
    """The weights of the blocks as rows ``(place, w0, …)``."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for b, cell in zip(batch["b"].to_pylist(), batch["weights"], strict=True):
                weights = np.frombuffer(cell.as_buffer()).reshape(-1, k)
                for i in range(0, len(weights), EXPECTED_ROWS):
                    part = np.ascontiguousarray(weights[i : i + EXPECTED_ROWS].T)
                    place = (np.arange(i, i + part.shape[1]) * n + b).astype(np.int32)
                    yield pa.record_batch([pa.array(place), *map(pa.array, part)], names=["place", *_columns(k)])

    return blocks.select("b", "weights").mapInArrow(rows, ", ".join(["place int", *[f"{c} double" for c in _columns(k)]]))


def _sent(blocks: DataFrame, k: int) -> DataFrame:
    """For each group and block the weights of the terms that the group holds: ``(g, b, weights)``."""

    def messages(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                b, groups, held = (batch[name][row] for name in ("b", "groups", "held"))
                weights = np.frombuffer(batch["weights"][row].as_buffer()).reshape(-1, k)
                for g, at in zip(groups.as_py(), held.values, strict=True):
                    part = weights[np.frombuffer(at.as_buffer(), np.int32)]
                    yield pa.record_batch([pa.array([g], pa.int32()), pa.array([b.as_py()], pa.int32()), _cells(part, [len(part)])], names=["g", "b", "weights"])

    return blocks.select("b", "weights", "groups", "held").mapInArrow(messages, "g int, b int, weights binary")


def _table(messages, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A group's weights, in the order in which it numbers its terms, and how many come from each block."""
    cells = _ordered(messages, "b", "weights", np.float64)
    return np.concatenate(cells).reshape(-1, k), np.array([len(cell) // k for cell in cells])


def _entries(docs) -> _Entries:
    sizes, at, counts = (np.concatenate(_ordered(docs, "slice", name, kind)) for name, kind in (("sizes", np.int32), ("at", np.int32), ("counts", np.float64)))
    return _Entries(sizes.astype(np.int64), at, counts)


def _pass_over(totals: list[float], alpha: float):
    """One pass over a group: what its documents add to the weights of its terms, packed by block."""

    def step(docs, messages):
        import pyarrow as pa

        weights, sizes = _table(messages, len(totals))
        expected, entries = _expected(weights, totals), _entries(docs)
        gamma, share = _infer(entries, expected, alpha)
        blocks, group = np.sort(messages["b"].to_numpy()), np.full(len(sizes), docs["g"][0].as_py(), np.int32)
        return pa.table({"b": blocks, "g": group, "added": _cells(_added(entries, expected, gamma, share), sizes)})

    return step


def _renewed(k: int, beta: float, rate: float):
    """The weights of a block after a pass."""

    def step(block, parts):
        groups, held = block["groups"][0].as_py(), block["held"][0].as_py()
        weights = np.frombuffer(block["weights"][0].as_buffer()).reshape(-1, k)
        at = dict(zip(groups, held, strict=True))
        added = np.zeros(weights.shape)
        for g, part in zip(sorted(parts["g"].to_pylist()), _ordered(parts, "g", "added", np.float64), strict=True):
            added[np.frombuffer(at[g], np.int32)] += part.reshape(-1, k)
        return _block(block["b"][0].as_py(), (1 - rate) * weights + rate * (added + beta), groups, held)

    return step


def _block_sums(blocks: DataFrame, k: int) -> list[float]:
    return list(blocks.agg(*[F.sum(F.col("totals")[i]) for i in range(k)]).first())


def topic_model(
    long: DataFrame,
    key: str,
    k: int,
    alpha: float = fixed.TOPIC_ALPHA,
    beta: float = fixed.TOPIC_DELTA,
    seed: int = fixed.TOPIC_SEED,
    max_iter: int = 20,
    n_docs: Column | None = None,
    min_share: float = 0.0,
) -> tuple[TopicModel, DataFrame, DataFrame]:
    """Fit online variational LDA on document-term counts ``(key, term, n)``.

    Returns the model, its term index and the term vectors per document. ``min_share`` bounds the terms as in the
    vocabulary module. Every text takes part in every pass. The weights are a table of blocks of terms: a pass sends each
    group of documents the weights of the terms it holds, one packed row per block, and each block adds up what the groups
    return; only the sums per topic pass the driver. What a pass has written is deleted when the next one has read it.
    """
    spark = long.sparkSession
    # The counts are read for the index and for the vectors; their texts are cut into terms once.
    long, counted = stored(long, "topic-counts")
    index = word_index(long, n_docs, min_share, word="term")
    # Passes read the groups, so the vectors are kept as compressed files.
    vectors, _ = stored(sparse_vectors(long, index, [key], "n", word="term").hint("rebalance"), "topic-vectors")
    discard(spark, counted)
    groups = _grouped(vectors, key)
    blocks, at = stored(_blocks(_drawn(index, k, seed), groups, k), "topic-weights")
    totals = _block_sums(blocks, k)
    for iteration in range(1, max_iter + 1):
        sweep(spark)
        rate = (LEARNING_OFFSET + iteration) ** -LEARNING_DECAY
        documents = groups.docs.select("g", "slice", "sizes", "at", "counts").groupBy("g")
        parts = documents.cogroup(_sent(blocks, k).groupBy("g")).applyInArrow(_pass_over(totals, alpha), "b int, g int, added binary")
        renewed = blocks.groupBy("b").cogroup(parts.groupBy("b")).applyInArrow(_renewed(k, beta, rate), BLOCK)
        before = at
        blocks, at = stored(renewed, "topic-weights")
        discard(spark, before)
        totals = _block_sums(blocks, k)
    sweep(spark)
    return TopicModel(_unpacked(blocks, groups.blocks, k), totals, alpha, (vectors, groups, blocks)), index, vectors


def _long(model: TopicModel) -> DataFrame:
    """``(place, topic, weight)`` with topics from 0; the weights of a topic sum to 1."""
    shares = [F.struct(F.lit(i).alias("topic"), (F.col(f"w{i}") / F.lit(t)).alias("weight")) for i, t in enumerate(model.totals)]
    return model.weights.select("place", F.inline(F.array(*shares)))


def topic_terms(model: TopicModel, index: DataFrame) -> DataFrame:
    """Topic-term weights as rows ``(topic, term, beta)``; the betas of a topic sum to 1."""
    named = model.weights.join(index.select("place", "term"), "place")
    shares = [F.struct(F.lit(i + 1).alias("topic"), (F.col(f"w{i}") / F.lit(t)).alias("beta")) for i, t in enumerate(model.totals)]
    return named.select("term", F.inline(F.array(*shares))).select("topic", "term", "beta")


def doc_topics(model: TopicModel, vectors: DataFrame, key: str) -> DataFrame:
    """Document-topic weights as rows ``(key, topic, gamma)``; all are 0 for a document without a term."""
    k, totals, alpha = len(model.totals), model.totals, model.alpha
    if model.fitted is not None and model.fitted[0] is vectors:
        _, groups, blocks = model.fitted
    else:
        groups = _grouped(vectors, key)
        blocks = _blocks(model.weights, groups, k)
    empty = vector_entries(vectors, [key]).filter(F.size("places") == 0).select(key, F.array_repeat(F.lit(0.0), k).alias("_g"))

    def mixed(docs, messages):
        import pandas as pd
        import pyarrow as pa

        entries, weights = _entries(docs), _table(messages, k)[0]
        cuts = np.cumsum(entries.sizes)[:-1]
        frame = pd.DataFrame({"places": pd.Series(np.split(entries.at, cuts), dtype=object), "values": pd.Series(np.split(entries.counts, cuts), dtype=object)})
        terms = pd.DataFrame(weights, columns=_columns(k)).assign(place=np.arange(len(weights)))
        lists = docs["keys"]
        keys = pa.chunked_array([lists[int(i)].values for i in np.argsort(docs["slice"].to_numpy())])
        (part, _, _, gamma), = _group_steps(frame, terms, totals, alpha)
        shares = pa.array((gamma / gamma.sum(axis=1)[:, None]).ravel())
        return pa.table({key: keys.take(pa.array(part.index.to_numpy())), "_g": pa.ListArray.from_arrays(np.arange(0, len(shares) + 1, k, dtype=np.int32), shares)})

    # Keys go as text: they come back as what they were, whole numbers beside a null too.
    rows = groups.docs.groupBy("g").cogroup(_sent(blocks, k).groupBy("g")).applyInArrow(mixed, f"`{key}` string, _g array<double>")
    rows = rows.withColumn(key, F.col(key).cast(vectors.schema[key].dataType)).unionByName(empty)
    return rows.select(key, F.posexplode("_g").alias("_pos", "gamma")).select(key, (F.col("_pos") + 1).alias("topic"), "gamma")


def top_terms(beta: DataFrame, k: int) -> DataFrame:
    """The ``k`` heaviest terms of each topic, ties kept, numbered from the lightest up."""
    return topk(beta, ["topic"], "beta", k, ["term"], ties=True, index="asc").orderBy("topic", F.desc("beta"), "term")
