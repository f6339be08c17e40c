"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Statistics are ratios and logarithms of counts over the whole text; id, language, source and labels are none of
them. The trees are fitted on at most ``sample`` labelled rows, the ones with the least hash of their id, whose
statistics (one short row of numbers each, no texts) are the only thing the driver sees. Each column is cut into
at most 64 bins at quantiles; each tree grows level by level, the best split of a node taken from sums of
gradients per bin. The fitted trees are flat arrays; scoring walks all trees of an Arrow batch at once with
numpy and needs no shuffle.

Edge cases: a null text counts as empty and gets the score of an empty text; labels other than 0 and 1, null
labels and labels of unknown documents teach nothing; several labels of one document teach each; documents that
share an id teach by the means of their statistics, once per label; with one class
or no labelled rows the score is the share of label 1, or 0.5. Rows that repeat are scored each; an empty table
stays empty. Columns that are neither text nor ``keep`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.wordcut import slices

SAMPLE = 20_000
# Bytes of text that are Python strings at once.
SLICE_BYTES = 1_000_000
BINS, DEPTH, TREES, RATE, RIDGE, LEAST_ROWS = 64, 4, 60, 0.15, 1.0, 10

STOP_WORDS = frozenset(
    b"the of and to in is was for that with on as at by it this are from an or be "
    b"de la le les des et un une en du est pour que dans der die und das den von zu mit "
    b"ist ein eine nicht el los las por con su es se del".split()
)
STATISTICS = (
    "log_words", "word_length", "symbols", "marks", "bars", "digits", "upper", "stops", "commas", "distinct",
    "top_word", "line_words", "dup_lines", "repeat_pairs",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """The numbers a text is judged by."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words) or 1, len(data) or 1
    count = lambda chars: len(data) - len(data.translate(None, chars))
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    top = int(np.bincount(codes).max()) if len(codes) else 0
    pairs = codes[:-1] * (len(ids) + 1) + codes[1:]
    lines = [x for x in data.split(b"\n") if x.strip()]
    stops = np.fromiter((w in STOP_WORDS for w in ids), bool, len(ids))
    return (
        float(np.log1p(len(words))),
        (size - count(b" \t\n\x0b\f\r")) / n,
        count(b"#*$%&<>") / n,
        count(b"!") / n,
        count(b"|") / n,
        count(b"0123456789") / size,
        count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size,
        float(stops[codes].sum()) / n if len(codes) else 0.0,
        count(b".,;:") / n,
        len(ids) / n,
        top / n,
        len(words) / (len(lines) or 1),
        1 - len(set(lines)) / (len(lines) or 1) if lines else 0.0,
        1 - len(np.unique(pairs)) / len(pairs) if len(pairs) else 0.0,
    )


class Trees(NamedTuple):
    """All trees as arrays: split column and threshold of every inner node, value of every leaf."""

    column: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.start)
        rows, depth = np.arange(len(x)), int(np.log2(self.leaf.shape[1]))
        for column, threshold, leaf in zip(self.column, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, column[node]] > threshold[node])
            total += leaf[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the logistic loss."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    start, inner, leaves = float(np.log(share / (1 - share))), 2**depth - 1, 2**depth
    if len(np.unique(y)) < 2:
        trees = 0
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T] if trees else []
    binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T, strict=True)], 1) if trees else None
    columns, thresholds, values = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h, node = p - y, p * (1 - p), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain_best = np.full(width, 1e-9)
            for c, k in enumerate(cuts):
                at = (node - first) * BINS + binned[:, c]
                sums = [np.bincount(at, w, width * BINS).reshape(width, BINS) for w in (g, h, np.ones(len(y)))]
                (gl, hl, nl), (ga, ha, na) = [s.cumsum(1) for s in sums], [s.sum(1, keepdims=True) for s in sums]
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(nl < LEAST_ROWS) | (na - nl < LEAST_ROWS)] = -1
                gain = gain[:, : len(k)]
                if not gain.shape[1]:
                    continue
                best = gain.argmax(1)
                for w in np.flatnonzero(gain.max(1) > gain_best):
                    gain_best[w], columns[t, first + w], thresholds[t, first + w] = gain[w, best[w]], c, k[best[w]]
            node = 2 * node + 1 + (x[np.arange(len(y)), columns[t, node]] > thresholds[t, node])
        node -= inner
        values[t] = -RATE * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + RIDGE)
        total += values[t][node]
    return Trees(columns, thresholds, values, start)


def _with_statistics(texts: DataFrame, text: str) -> DataFrame:
    """All columns but the text, and the statistics as one array."""
    others = [c for c in texts.columns if c != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != text), "stats array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole, text, SLICE_BYTES)):
            stats = pa.array([statistics(t) for t in b.column(text).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), stats], names=[*others, "stats"])

    return texts.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled rows of ``docs``."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(sample)
        .groupBy("_id", "_label")
        .agg(F.count("*").alias("_times"))
    )
    # At most ``sample`` ids and labels: a bound that holds at any size, so they may be broadcast.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = _with_statistics(texts.select("_id", "_label", "_times", "_text"), "_text")
    # Documents that share an id are one row of means, summed up per task, so that the bound holds before anything is collected.
    means = F.array(*[F.avg(F.col("stats")[k]) for k in range(len(STATISTICS))]).alias("stats")
    rows = rows.groupBy("_id", "_label", "_times").agg(means).toPandas().sort_values(["_id", "_label"])
    if not len(rows):
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    rows = rows.loc[rows.index.repeat(rows["_times"])]
    return fit(np.stack(rows["stats"].to_numpy()), rows["_label"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, text: str = "text", keep: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` (the text may be among them) and the score of every document."""
    keep = list(keep)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` double"])
    columns = [*keep, *([text] if text not in keep else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for whole in batches for s in slices(whole, text, SLICE_BYTES)):
            x = np.array([statistics(t) for t in b.column(text).to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(trees.score(x))], names=[*keep, name])

    return docs.select(*columns).mapInArrow(run, schema)
