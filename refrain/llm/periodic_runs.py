"""Periodic runs of words: stretches that repeat with a period, found by seeds that are extended along diagonals.

A run is a stretch of consecutive words with smallest period ``q`` whose length is at least ``max(least, repeats * q)``
and that no neighbouring word extends. Words ``q`` apart are equal over ``length - q`` words, the guaranteed overlap.

1. Index. Lags are taken in classes from a power of two up to the next. In the class of ``low`` the overlap is at
   least ``(repeats - 1) * low`` words, so grams of that many words are the seeds of the class. With ``repeats`` 4 a
   gram is at least one and a half lags long; two places of it in a run that were nearer than the period would give
   the run a smaller one. So only the next place of a gram has to be looked at: there is one pair of places per gram
   and class, not all pairs, and the lag of a pair is the smallest period.
2. Grams are hashed by doubling. A gram can recur only if the shorter one it begins with recurs, so each class sorts
   only the places that the one before left, and prose without repeats is sorted once.
3. Pairs are extended on their diagonal, words compared themselves. A table of the furthest word covered per lag
   skips pairs inside a run that is known, so each run is extended once.

Texts lie in one row each and pairs never leave their text, so nothing is shuffled. The work for a text of n words is
at most n log n, also when it consists of one word repeated.

Edge cases: null and empty texts have no runs and collapse to an empty text; rows are handled one by one, so repeated
rows, ties and null ids are kept as they are; an empty table gives no rows. A kept column may not be called ``n_words``,
``runs`` or ``collapsed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.wordcut import BY_BLANKS, slices, words_of

SLICE_BYTES = 4_000_000
REPEATS = 4
LEAST = 6
RUNS = "array<struct<start: long, length: long, period: long>>"
RESULTS = ("n_words", "runs", "collapsed")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two numbers per place."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _joined(grams: np.ndarray, ahead: int) -> np.ndarray:
    """Hash of each gram and the one ``ahead`` words further; the last places have none."""
    return _mixed(grams[: len(grams) - ahead], grams[ahead:]) if len(grams) > ahead else grams[:0]


def _recurring(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``at``: those whose gram has another place, and all pairs of neighbouring places of a gram."""
    at = at[at < len(grams)]
    held = grams[at]
    if len(at) > 1:
        in_order = np.sort(held)
        twice = in_order[1:][in_order[1:] == in_order[:-1]]
        at = at[np.isin(held, twice)] if len(twice) else at[:0]
    else:
        at = at[:0]
    order = at[np.argsort(grams[at], kind="stable")]
    same = grams[order[1:]] == grams[order[:-1]]
    return at, order[:-1][same], order[1:][same]


def _extent(words: np.ndarray, low: int, high: int, place: int, lag: int) -> tuple[int, int]:
    """The stretch around ``place`` in which words equal those ``lag`` further, within words ``low`` to ``high``."""
    first = place
    while first > low and words[first - 1] == words[first - 1 + lag]:
        first -= 1
    last, step = place, 64
    while last + lag < high:
        n = min(step, high - lag - last)
        differ = np.flatnonzero(words[last : last + n] != words[last + lag : last + lag + n])
        if len(differ):
            return first, last + int(differ[0])
        last, step = last + n, step * 2
    return first, last


def runs_of(words: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run; ``words`` are numbers, ``text`` is the text of each, in order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(text))]) if len(text) else np.zeros(1, np.int64)
    one = _mixed(words.astype(np.uint64), text.astype(np.uint64))
    three = _joined(_joined(one, 1), 1)
    grams, size, low = _joined(three, least - 1 - 3), least - 1, 1
    places, furthest, found = np.arange(len(words)), {}, []
    while low * REPEATS <= len(words):
        places, here, there = _recurring(grams, places)
        if not len(places):
            break
        lag = there - here
        fit = (lag >= low) & (lag < 2 * low)
        order = np.lexsort((here[fit], lag[fit]))
        here, lag = here[fit][order], lag[fit][order]
        # Places in a row on one diagonal are one stretch: only the first of them is extended.
        head = np.ones(len(here), bool)
        head[1:] = (here[1:] != here[:-1] + 1) | (lag[1:] != lag[:-1])
        for place, q in zip(here[head].tolist(), lag[head].tolist(), strict=True):
            if place < furthest.get(q, 0):
                continue
            of = int(text[place])
            first, last = _extent(words, int(ends[of]), int(ends[of + 1]), place, q)
            furthest[q] = max(last, place + 1)
            if last > place and last - first + q >= max(least, REPEATS * q):
                found.append((of, first - int(ends[of]), last - first + q, q))
        # The grams of the next class: (REPEATS - 1) * low words, by doubling.
        grams, size = (_joined(three, 3), 6) if low == 1 else (_joined(grams, size), 2 * size)
        low *= 2
    return sorted(found)


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, n_words, runs (by start, then period) and the text without repeats.

    ``collapsed`` has every word but those that lie in a run after its first period, joined by single blanks.
    """
    kept = ["doc_id"] if keep is None else keep
    if clash := set(RESULTS) & {c.lower() for c in kept}:
        raise ValueError(f"columns named like results: {sorted(clash)}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", SLICE_BYTES):
                yield _searched(batch, kept)

    rows = docs.select(*[F.col(c) for c in kept], F.col(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(search, ", ".join([*fields, "n_words long", f"runs {RUNS}", "collapsed string"]))


def _searched(batch: pa.RecordBatch, kept: list[str]) -> pa.RecordBatch:
    words, text, _ = words_of(batch.column("_text"), BY_BLANKS)
    coded = words.dictionary_encode()
    n_words = np.bincount(text, minlength=batch.num_rows)
    ends = np.concatenate([[0], np.cumsum(n_words)])
    found = runs_of(coded.indices.to_numpy(), text)
    runs: list[list] = [[] for _ in range(batch.num_rows)]
    dropped = np.zeros(len(words) + 1, np.int64)
    for of, start, length, q in found:
        runs[of].append({"start": start, "length": length, "period": q})
        dropped[ends[of] + start + q] += 1
        dropped[ends[of] + start + length] -= 1
    stays = np.cumsum(dropped)[:-1] == 0
    spelt = words.filter(pa.array(stays)).to_pylist()
    left = np.concatenate([[0], np.cumsum(np.bincount(text[stays], minlength=batch.num_rows))])
    collapsed = [b" ".join(spelt[left[k] : left[k + 1]]).decode() for k in range(batch.num_rows)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    columns = [batch.column(c) for c in kept]
    return pa.record_batch(
        [*columns, pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
        names=[*kept, *RESULTS],
    )
