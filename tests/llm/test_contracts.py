"""Queries and pipeline stages recomputed row by row: classifier, mixing, packing, and what the stages do to documents."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from refrain.llm import pii, quality_classifier
from refrain.llm.queries import GOOD, QUERIES, vocabulary

STAGES = dict(corpus_pipeline.STAGES)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def walked(trees, row):
    """One row down every tree, node by node."""
    total, inner = trees.start, trees.column.shape[1] if len(trees.column) else 0
    for columns, thresholds, values in zip(trees.column, trees.threshold, trees.leaf, strict=True):
        node = 0
        while node < inner:
            node = 2 * node + 1 + int(row[columns[node]] > thresholds[node])
        total += values[node - inner]
    return 1 / (1 + np.exp(-total))


def targets(sizes, sources):
    """Target of every source: 150 % of all sizes by weight, at most twice its size, the excess shared again."""
    order = sorted((s for s in sources if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sources)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(out[s] for s in full)
        free -= full
    return out


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op2_quality_classifier"](spark, folder).collect()
    labels = dict(duckdb.sql(f"select doc_id, quality from '{folder}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= GOOD) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) in (0, 1)]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert len(good) > 20 and len(bad) > 20
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in bad]) > 0.9


def test_trees_against_a_walk():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(600, len(quality_classifier.STATISTICS))), 1)
    trees = quality_classifier.fit(x, (x[:, 0] + x[:, 3] * x[:, 4] > 0).astype(float))
    assert trees.score(x[:80]) == pytest.approx([walked(trees, r) for r in x[:80]])


def test_mixing_against_recomputation(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op5_mixing"](spark, small).collect()
    size = {k: len(WORDS.findall(r.text or "")) for k, r in docs.items()}
    by_source = collections.Counter()
    for k, r in docs.items():
        by_source[r.source] += size[k]
    want, taken, largest = targets(by_source, set(by_source)), collections.Counter(), collections.Counter()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        source = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], by_source[source])
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    assert all(abs(taken[s] - want[s]) <= max(largest[s], 0.03 * want[s]) for s in want)


def test_packed_pieces_against_the_tokenizer(spark, small):
    coder = Tokenizer.from_file(vocabulary())
    ids = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids[r.doc_id] = np.array([*coder.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
    covered = collections.defaultdict(list)
    for r in QUERIES["op10_packing"](spark, small).collect():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(piece), zlib.crc32(piece.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
        covered[r.doc_id].append((r.start, r.length))
    for k, whole in ids.items():
        at = 0
        for start, length in sorted(covered[k]):
            assert start == at
            at += length
        assert at == len(whole)


def test_stages_take_effect(spark, small):
    """Each stage against its own input: documents rejected, masked and copied are the ones that should be."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    trees = quality_classifier.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    before = {r.doc_id: r for r in docs.collect()}
    scores = {k: walked(trees, quality_classifier.statistics(r.text)) for k, r in before.items()}
    kept = {r.doc_id: r for r in STAGES["quality classifier"](spark, docs, small).collect()}
    clear = {k for k, s in scores.items() if abs(s - GOOD) > 1e-9}
    assert kept.keys() & clear == {k for k in clear if scores[k] >= GOOD} and 0 < len(kept) < len(before)
    assert all(kept[k] == before[k] for k in kept)

    planted = spark.createDataFrame([(10**6, "call (415) 555-2671 or joe at example dot com or 10.0.0.7 now", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(planted.select([planted[f.name].cast(f.dataType).alias(f.name) for f in docs.schema]))
    weights, changed = pii.train(docs), 0
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in STAGES["pii"](spark, docs, small).collect()}
    assert after.keys() == before.keys()
    for k, r in before.items():
        text = r.text and pii.masked(r.text, pii.find(r.text, weights)[1])
        assert after[k].text == text and (after[k].lang, after[k].source) == (r.lang, r.source)
        assert text is None or after[k].n_chars == len(text)
        changed += text != r.text
    assert changed > 1 and after[10**6].text == "call <PHONE> or <EMAIL> or <IP> now"

    docs = spark.read.parquet(f"{small}/documents.parquet")
    copies = {r.doc_id: r.copies for r in QUERIES["op5_mixing"](spark, small).collect()}
    mixed = collections.Counter(r.doc_id for r in STAGES["mixing"](spark, docs, small).select("doc_id").collect())
    assert mixed == collections.Counter({k: n for k, n in copies.items() if n})
