"""Collocations, periodic runs and best-fit packing against brute force on small tables."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from refrain.llm import best_fit, collocations, periodic_runs
from refrain.llm.queries import QUERIES, vocabulary, with_planted_runs
from refrain.llm.wordcut import BY_BLANKS, BY_PIECES, slices, words_of

# Columns clash with results: n, rank, phrase, runs, piece, length.
DOCS = "doc_id long, text string, lang string, n int, rank string, phrase string, runs int, piece int, length long"
LONG = " ".join(f"w{k % 997}x{k % 31}" for k in range(30_000))


def frame(spark, texts):
    """Rows of (id, text, lang) with clashing columns."""
    return spark.createDataFrame([(k, t, g, 1, "r", "p", 2, 3, 4) for k, t, g in texts], DOCS)


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and very long texts, ties, repeated rows."""
    draw = random.Random(5)
    some = [(k, " ".join(draw.choice(["a", "b", "of", "The", "x.", "é", "ß,"]) for _ in range(draw.randint(0, 40))), draw.choice(["en", "de", None, "und"])) for k in range(60)]
    more = [(1, None, "en"), (2, "", None), (2, "", None), (None, "a b a b a b a b a b", "en"), (7, LONG, "fr"), (8, "x " * 9000, "fr"), (9, "\x0b\n\t", "en")]
    return some + more + some[:5]


def brute_phrases(texts, least, share=50, top=2000):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    small = {c: c + 32 for c in range(65, 91)}
    for _, text, lang in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(small)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang or "und"] += len(words)
            for n in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            if len(phrase) == 2 and any(100 * b >= share * a and b >= least and phrase in (p[:2], p[1:]) for p, b in f.items() if len(p) == 3):
                continue
            score, k = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrases(docs, **how):
    rows = collocations.collocations(docs, **how).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 7)])
def test_phrases_against_brute_force(spark, texts, least, top):
    assert phrases(frame(spark, texts), least=least, top=top) == brute_phrases(texts, least, top=top)


def test_phrases_do_not_depend_on_buckets_or_slices(spark, texts, monkeypatch):
    monkeypatch.setattr(collocations, "WORDS_A_BUCKET", 100)
    monkeypatch.setattr(collocations, "HEAVY", 3000)  # most prefixes are cut by the next word
    assert phrases(frame(spark, texts).repartition(5), least=3) == brute_phrases(texts, 3)


def test_phrases_of_no_documents(spark, texts):
    assert phrases(frame(spark, [])) == [] and phrases(frame(spark, [(1, None, None)])) == []


def test_scores_are_exact_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**14 - 1, 10**14, 10**14), (3, 7, 11)], "a long, l long, r long")
    got = [r.s for r in rows.select(collocations._score("a", "l", "r").alias("s")).collect()]
    assert got == [10**6 * (10**14 - 1) ** 2 // 10**28, 10**6 * 9 // 77]


def test_positions_are_counted_in_steps(monkeypatch):
    """A text of more words than one step counts the phrases across the border once."""
    codes = np.array([random.Random(3).randrange(5) + 1 for _ in range(1000)], np.int64)
    piece = np.arange(1000) // 37
    whole, cut = collections.Counter(), collections.Counter()
    for add, step in ((whole, 1 << 20), (cut, 64)):
        monkeypatch.setattr(collocations, "POSITIONS", step)
        for part in collocations._counted(codes, piece):
            for one, two, three, n in zip(*(x.tolist() for x in part), strict=True):
                add[one, two, three] += n
    assert whole == cut and sum(whole.values()) == 1000


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            first = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            size = i - first + q
            part = w[first : first + size]
            if size >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((first, size, q))
            i += 1
    return sorted(out)


def test_runs_of_random_words():
    draw = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(0, 4)):
            few, words = draw.choice([1, 2, 2, 3, 5]), []
            while len(words) < draw.choice([0, 5, 30, 90]):
                stem = [draw.randrange(few) for _ in range(draw.randint(1, 9))]
                words += (stem * draw.randint(1, 8))[: draw.randint(1, 70)]
            texts.append(words)
        flat = np.array([x for w in texts for x in w], np.int32)
        of = np.array([k for k, w in enumerate(texts) for _ in w], np.int64)
        assert periodic_runs.runs_of(flat, of) == [(k, *run) for k, w in enumerate(texts) for run in brute_runs(w)]


def test_one_word_for_ever_is_one_run():
    """Pairs stay few and each run is extended once, however long it is."""
    n = 300_000
    assert periodic_runs.runs_of(np.zeros(n, np.int32), np.zeros(n, np.int64)) == [(0, 0, n, 1)]
    assert periodic_runs.runs_of((np.arange(n) % 5000).astype(np.int32), np.zeros(n, np.int64)) == [(0, 0, n, 5000)]


def test_runs_and_collapsed_texts(spark, texts):
    docs = frame(spark, texts)
    got = periodic_runs.find_runs(docs, keep=["doc_id", "phrase"]).collect()
    want = []
    for k, text, _ in texts:
        words = [w for w in re.split("[ \t-\r]+", text or "") if w]
        runs = brute_runs(words) if len(words) < 20_000 else [(r["start"], r["length"], r["period"]) for x in got if x.doc_id == k and x.n_words > 20_000 for r in x.runs]
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        want.append((k, len(words), tuple(runs), " ".join(w for i, w in enumerate(words) if i not in gone)))
    rows = [(r.doc_id, r.n_words, tuple((x["start"], x["length"], x["period"]) for x in r.runs), r.collapsed) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert periodic_runs.find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, keep=["doc_id", "runs"])


def test_planted_runs_follow_their_formula(spark, texts):
    got = {(r.doc_id, tuple(r.text.split())) for r in with_planted_runs(frame(spark, texts)).filter("text is not null").collect()}
    want = set()
    for k, text, _ in texts:
        words = [w for w in re.split("[ \t-\r]+", text or "") if w]
        h = zlib.crc32(str(k).encode()) if k is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if text is not None:
            want.add((k, tuple(words)))
    assert got == want


def check_packed(rows, texts, length, end, coder):
    """Every id in one piece, only long documents cut, sequences gapless from 0."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    want = collections.defaultdict(list)
    for k, text, *_ in texts:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        for piece, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            want[k].append((piece, at, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    for held in by_sequence.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


def test_packed_pieces(spark, texts):
    coder = Tokenizer.from_file(vocabulary())
    rows = best_fit.pack(frame(spark, texts).repartition(4), vocabulary(), length=128).collect()
    check_packed(rows, texts, 128, 1, coder)
    assert best_fit.pack(frame(spark, []), vocabulary()).count() == 0


def test_packing_of_the_table(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op13_best_fit_packing"](spark, small).collect()
    sequences = check_packed(rows, docs, 4096, 1, Tokenizer.from_file(vocabulary()))
    assert sequences <= -(-sum(r.length for r in rows) // 4096) + 1


def optimum(items, length):
    best, items = [len(items)], sorted(items, reverse=True)

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[at] <= length}.values():
            place(at + 1, [*bins[:k], bins[k] + items[at], *bins[k + 1 :]])
        place(at + 1, [*bins, items[at]])

    place(0, [])
    return best[0]


def sequences_of(counts, length):
    """Sequences of a plan; every piece has one place in it and none is filled over its length."""
    filled, seen = collections.Counter(), collections.defaultdict(list)
    for size, first, sequence, offset, times in best_fit.plan(counts, length).tolist():
        seen[size].extend(range(first, first + times))
        for k in range(times):
            assert filled[sequence + k] == offset
            filled[sequence + k] += size
    assert all(sorted(seen[size]) == list(range(n)) for size, n in enumerate(counts.tolist()))
    assert max(filled.values(), default=0) <= length
    return len(filled)


def test_plans_are_near_the_optimum():
    draw = random.Random(2)
    above = collections.Counter()
    for _ in range(150):
        items = [draw.randint(1, 20) for _ in range(draw.randint(0, 10))]
        above[sequences_of(np.bincount(items or [0], minlength=21) * (np.arange(21) > 0), 20) - optimum(items, 20)] += 1
    assert max(above) <= 1 and above[0] >= 140


def test_a_third_of_all_pieces_may_have_one_length():
    draw = np.random.default_rng(4)
    items = np.where(draw.random(20_000) < 0.33, 700, draw.integers(1, 2000, 20_000))
    counts = np.bincount(items, minlength=4097)
    assert sequences_of(counts, 4096) <= 1.01 * items.sum() / 4096


def test_rows_of_a_plan_do_not_grow_with_the_pieces():
    draw = np.random.default_rng(4)
    counts = np.bincount(np.clip(draw.lognormal(6.2, 1.0, 200_000).astype(int) + 1, 1, 4096), minlength=4097)
    few, many = (len(best_fit.plan(counts * k, 4096)) for k in (1, 1000))
    assert many < 2 * few


def test_words_at_byte_level():
    texts = pa.array(["Ab c.D\té", None, "", "x\ny", " \t\n"])
    words, text, piece = words_of(texts, BY_PIECES, lower=True)
    assert words.to_pylist() == [w.encode() for w in ("ab", "c", "d", "é", "x", "y")]
    assert text.tolist() == [0, 0, 0, 0, 3, 3] and len(set(piece.tolist())) == 4
    assert [w.decode() for w in words_of(texts, BY_BLANKS)[0].to_pylist()] == ["Ab", "c.D", "é", "x", "y"]
    batch = pa.record_batch([texts], names=["t"])
    assert [b.num_rows for b in slices(batch, "t", 8)] == [1, 4] and [b.num_rows for b in slices(batch, "t", 1)][0] == 1
