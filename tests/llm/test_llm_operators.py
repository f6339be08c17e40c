"""Operators of the subpackage on small tables, against literal cases and brute force."""

from __future__ import annotations

import collections
import gzip
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import canon
from refrain.llm import embedding_dedup, language_model, mixing, ngram_join, packing, pii, quality_classifier
from refrain.llm import quality_rules, url_filters, warc
from refrain.llm.components import components
from refrain.llm.queries import QUERIES, vocabulary
from refrain.llm.sql import ORACLE

DOCS = "doc_id long, text string, source string, size int, node string"
LONG = " ".join(f"w{k % 997}x{k % 31}" for k in range(30_000))
PLAIN = "the quick brown fox and the lazy dog ran to the river in the evening for it was warm"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns that clash with results."""
    rows = [
        (1, PLAIN, "a", 1, "x"), (2, PLAIN, "a", 1, "x"), (2, PLAIN, "a", 1, "x"), (3, PLAIN + " indeed", "b", 2, None),
        (4, "", None, None, "y"), (5, None, "b", 3, "y"), (None, PLAIN, "c", 4, "z"), (6, LONG, "c", 5, "z"),
        (7, "two words", "a", 6, "q"), (8, "two words", "d", 6, "q"), (9, "\n \t\n", None, 0, ""),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark, frame):
    return spark.createDataFrame([], frame.schema)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, small, name):
    got, want = QUERIES[name](spark, small).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.Net/x"), (2, "https://www.example.net/en/1?q"), (3, None), (4, "no scheme"), (5, "http://net"), (5, "http://a.org/fr/z#"),
         (6, "http://xnet/"), (7, "http://h.example.com/de/" + "d/" * 3000)],
        "page_id long, url string",
    ).selectExpr("*", "url as host2")
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block"), ("org", "/fr/", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    got = [(r.page_id, r.rule, r.verdict) for r in url_filters.judge_urls(pages, rules).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "net/", "block"), (2, "example.net/en/", "allow"), (3, None, "allow"), (4, None, "allow"), (5, None, "allow"),
         (5, "org/fr/", "allow"), (6, None, "allow"), (7, "example.com/de", "block")], key=str
    )
    assert url_filters.judge_urls(empty(spark, pages), rules).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, empty(spark, rules)).collect()} == {"allow"}


def test_rules_edge_cases(spark, docs):
    got = {(r.doc_id, r.n_words, r.kept) for r in quality_rules.apply_rules(docs).collect()}
    assert {(4, 0, False), (5, 0, False), (9, 0, False), (6, 30_000, False)} <= got
    assert quality_rules.apply_rules(empty(spark, docs)).count() == 0


def test_warc_round_trip(spark):
    big = "é" * 60_000
    rows = [(1, "u", big), (2, None, big), (3, "u", None), (4, "u\r\nx", "short"), (5, "u", "short"), (None, "u", "n" * 200), (7, "u", "WARC/1.1\r\n\r\n" * 30), (7, "u", "WARC/1.1\r\n\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = warc.read_archives(spark, warc.write_archives(pages, segment_bytes=1000)).collect()
    want = [(p, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for p, _, h in rows]
    assert sorted(((r.page, r.payload_bytes, r.payload_digest) for r in back), key=str) == sorted(want, key=str)
    assert all(r.complete for r in back)
    assert {(r.page, r.refers) for r in back if r.record_type == "revisit"} == {(2, 1)}
    assert warc.read_archives(spark, warc.write_archives(empty(spark, pages))).count() == 0


def test_chunked_framing():
    for size in (0, 1, 8192, 8193, 20_000):
        assert warc.unchunked(warc.chunked(b"x" * size)) == b"x" * size
    for bad in (b"", b"5\r\nab", b"2\r\nabcd"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_classifier(spark, docs):
    good = [(k, f"{PLAIN} number {k}") for k in range(60)]
    bad = [(100 + k, "### !!! $$$ " * (k + 2)) for k in range(60)]
    texts = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in good + bad] + [(None, 1), (5, None)], "doc_id long, quality int")
    trees = quality_classifier.train(texts, labels)
    scores = {r.doc_id: r.score for r in quality_classifier.score(texts, trees).collect()}
    assert min(scores[k] for k, _ in good) > 0.7 > max(scores[k] for k, _ in bad)
    edge = quality_classifier.score(docs, trees).collect()
    assert len(edge) == docs.count() and all(0 <= r.score <= 1 for r in edge)
    none = quality_classifier.train(texts, empty(spark, labels))
    assert {r.score for r in quality_classifier.score(texts, none).collect()} == {0.5}


def test_mixing(spark, docs):
    got = mixing.mix(docs, keep=["doc_id"]).toPandas()
    assert len(got) == docs.count() and got.copies.between(0, 2).all()
    targets = got.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"))
    assert math.isclose(targets["target"].sum(), 1.5 * targets["size"].sum(), rel_tol=1e-9)
    assert (targets["target"] <= 2 * targets["size"]).all()
    assert mixing.mix(empty(spark, docs), keep=["doc_id"]).count() == 0


def test_mix_comes_near_and_reruns_agree(spark, small):
    first, second = (QUERIES["op5_mixing"](spark, small).toPandas() for _ in range(2))
    assert canon(first) == canon(second)
    sums = first.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((sums.taken - sums.target).abs() <= 0.02 * sums.target + 20).all()


def brute_classes(texts, threshold=0.8):
    words = {k: (t or "").encode().split() for k, t in texts}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for k, w in words.items()}
    links, least = collections.Counter(), {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((least[a], least[b]))
                least = {k: low if v == high else v for k, v in least.items()}
    return {k: (least[k], links[k]) for k in sets}


def test_links_of_a_large_group_are_a_row_per_member_and_one_per_pair_of_blocks():
    """Tasks of two blocks name roots alone, and the components are those of all likely pairs."""
    draw = np.random.default_rng(1)
    groups = [draw.integers(0, 1 << 30, 64) for _ in range(3)]
    sig, size, blocks = [], 300, 4
    for k in range(size):
        own = groups[k % 2 if k < size - 5 else 2].copy()
        own[draw.choice(64, 8, replace=False)] = draw.integers(0, 1 << 30, 8)
        sig.append(own)
    sig, mine = np.array(sig), np.array([k * 7 % blocks for k in range(size)])
    edges = []
    for x in range(blocks):
        for y in range(x, blocks):
            at = np.flatnonzero((mine == x) | (mine == y))
            root = ngram_join._roots_in(sig[at], mine[at], x != y)
            edges += [(x != y, at[k], at[root[k]]) for k in range(len(at)) if root[k] != k]
    assert sum(not cross for cross, *_ in edges) <= size and sum(cross for cross, *_ in edges) <= 3 * blocks * blocks
    a, b = (np.array([e[k] for e in edges]) for k in (1, 2))
    assert (ngram_join._forest((a, b), size) == ngram_join._forest(ngram_join._likely_in(sig), size)).all()


def test_join_against_brute_force(spark, small):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op7_ngram_join"](spark, small).collect()}
    assert got == brute_classes(texts)


def test_join_edge_cases(spark, docs):
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(docs).collect())
    assert got[(2, 1, 4)] == 2 and got[(1, 1, 4)] == 1 and got[(None, 1, 4)] == 1 and got[(3, 1, 4)] == 1
    assert got[(7, 7, 1)] == 1 and got[(8, 7, 1)] == 1 and got[(4, 4, 0)] == 1 and got[(6, 6, 0)] == 1
    assert ngram_join.join(empty(spark, docs)).count() == 0


def test_join_splits_large_groups(spark):
    base = [f"t{k}" for k in range(60)]
    texts = [(k, " ".join([*base, f"own{k}"])) for k in range(150)]
    got = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"), bucket=16, block=32).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 149)}


def test_join_of_texts_around_one_passage(spark):
    """A passage that fills half of many texts keeps their buckets whole; only real pairs come out linked."""
    draw, passage = np.random.default_rng(3), " ".join(f"p{k}" for k in range(40))
    texts = [(k, f"{passage} " + " ".join(f"w{x}" for x in draw.integers(0, 9999, 30))) for k in range(80)]
    texts += [(100 + k, texts[k][1] + " end") for k in range(40)]
    got = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"), bucket=8, block=16).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute_classes(texts)


def test_components(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in components(chain, "test").collect()} == {(k, 0) for k in range(21)} | {(100, 100), (101, 100)}


def record(fields, block=b"", length=None):
    head = "".join(f"{k}:{v}\r\n" for k, v in fields.items())
    size = "" if length == "" else f"Content-Length: {len(block) if length is None else length}\r\n"
    return f"WARC/1.1\r\n{head}{size}\r\n".encode() + block + b"\r\n\r\n"


def test_warc_reads_damaged_and_foreign_records(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nhello"
    page = lambda k: {"WARC-Type": "response", "WARC-Record-ID": f"<urn:x-page:{k}:d>"}
    foreign = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:6f1e>", "WARC-Payload-Digest": "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}
    records = [
        record({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:1>"}, b"software: x"),
        record(page(1), http),
        record(page(2), b"stray bytes", length=""),
        record(page(3), http, length="many"),
        record({"WARC-Record-ID": "<urn:x-page:4:d>"}, http),
        record({"WARC-Type": "response"}, http),
        record(foreign, http),
        record(page(5), b"no header end"),
        record({**page(6), "WARC-Segment-Number": "one"}, http),
        record(page(7) | {"WARC-Payload-Digest": "sha256:" + "0" * 64}, http),
        record(page(8), b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n-5\r\nab\r\n"),
    ]
    (tmp_path / "a.gz").write_bytes(b"".join(gzip.compress(r) for r in [*records, record(page(9), http)[:-20]]))
    (tmp_path / "b.gz").write_bytes(gzip.compress(record(page(10), http)) + gzip.compress(record(page(11), http * 50))[:40])
    (tmp_path / "c.gz").write_bytes(b"not an archive")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    own = hashlib.sha256(b"hello").hexdigest()
    good = {(r.page, r.payload_bytes, r.payload_digest) for r in rows if r.complete}
    assert good == {(1, 5, own), (None, 5, own), (10, 5, own)}
    bad = collections.Counter(r.page for r in rows if not r.complete)
    assert all(bad[k] == 1 for k in (2, 3, 4, 5, 6, 7, 8, 9)) and bad[None] >= 2
    assert all(r.complete is not None for r in rows)


def test_frequent_urls_and_payloads_are_split(spark):
    """The last join of the URL filters splits a frequent url; so does that of the archives a frequent payload."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        url = F.when(F.col("id") % 2 == 0, "http://a.net/hot").otherwise(F.concat(F.lit("http://h"), F.col("id"), F.lit(".org/x")))
        body = F.when(F.col("id") % 2 == 0, "hot " * 50).when(F.col("id") % 3 == 0, "short").otherwise(F.concat(F.repeat(F.lit("own "), 30), F.col("id")))
        pages = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("page_id"), url.alias("url"), body.alias("html"))
        rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
        for frame in (url_filters.judge_urls(pages, rules), warc.mark_repeats(pages)):
            frame.write.format("noop").mode("overwrite").save()
            frame._jdf.queryExecution().executedPlan().execute().count()
            text = frame._jdf.queryExecution().executedPlan().toString()
            last = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
            assert "skew=true" in next(line for line in last.splitlines() if "Join" in line)
        assert warc.mark_repeats(pages).filter("first = 0").count() == 19_999
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def brute_links(rows, cosine=0.93):
    """(links, least id reached) by id of rows (id, vector, label) with usable vectors of one length."""
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.array([r[2] for r in rows])
    linked = (x @ x.T >= cosine) & (labels[:, None] == labels)
    np.fill_diagonal(linked, False)
    least = np.array([r[0] for r in rows])
    while True:
        after = np.array([min([least[k], *least[linked[k]]]) for k in range(len(rows))])
        if (after == least).all():
            return {r[0]: (int(linked[k].sum()), int(least[k])) for k, r in enumerate(rows)}
        least = after


def found_links(frame, **options):
    return {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(frame, **options).collect()}


VECTORS = "vec_id long, embedding array<double>, label int"


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.2 * rng.normal(size=16)).tolist(), k % 3) for k in range(200)]
    rows += [(200, rows[0][1], 0), (201, None, 0), (202, [0.0] * 16, 0), (203, [math.nan] * 16, 0), (204, rows[0][1], None), (205, [1.0, None], 1)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as node")
    assert found_links(frame, block=16) == brute_links(rows[:201]) | {k: (0, k) for k in range(201, 206)}
    assert embedding_dedup.near_duplicates(empty(spark, frame)).count() == 0


def test_embeddings_split_over_levels(spark):
    """One label: vectors without clusters, a chain of neighbours, a ball of near copies larger than a block, copies by scale."""
    rng = np.random.default_rng(5)
    loose = [rng.normal(size=12) for _ in range(150)]
    angles = np.arange(40) * 0.3
    chain = [np.r_[np.cos(t), np.sin(t), np.zeros(10)] for t in angles]
    ball = [np.r_[np.zeros(4), 1.0, np.zeros(7)] + 0.02 * rng.normal(size=12) for _ in range(120)]
    wide = [np.r_[np.zeros(7), 1.0, np.zeros(4)] + 0.11 * rng.normal(size=12) for _ in range(120)]
    scaled = [ball[0] * 3, ball[0] * 1e-3, loose[0] * 7]
    vectors = loose + chain + ball + wide + scaled
    order = rng.permutation(len(vectors))
    rows = [(int(k), vectors[o].tolist(), 0) for k, o in enumerate(order)]
    assert found_links(spark.createDataFrame(rows, VECTORS), block=48) == brute_links(rows)


def test_pairs_of_trees_against_all_pairs():
    rng = np.random.default_rng(7)
    for spread in (0.01, 0.08, 0.2, 1.0):
        x = embedding_dedup.unit(rng.normal(size=(9, 10))[rng.integers(0, 9, 700)] + spread * rng.normal(size=(700, 10)))
        for a, b in ((np.arange(700), None), (np.arange(300), np.arange(300, 700))):
            times = np.zeros((700, 700), int)
            for p, q, matrix in embedding_dedup.dual_links(x, a, b, 0.93):
                times[np.ix_(p, q)] += 1 if matrix is None else matrix
            wanted = x @ x.T >= 0.93
            if b is None:
                times = np.triu(times + times.T * (times == 0), 1)
                wanted = np.triu(wanted, 1)
            else:
                wanted[300:] = wanted[:, :300] = False
            assert (times == wanted).all()


def test_language_model(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    tokens = {r.doc_id: (r.text or "").encode().lower().split() + [b" end"] for r in rows}
    train = collections.Counter(w for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in t)
    n, v = sum(train.values()), len(train)
    for r in QUERIES["op8_language_model"](spark, small).collect():
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(train[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), abs_tol=1e-6)
        assert r.score <= 0


def test_language_model_edge_cases(spark, docs):
    from pyspark.sql import functions as F

    got = language_model.score(docs, F.lit(True)).collect()
    assert len(got) == docs.count() and {r.n_tokens for r in got if r.doc_id in (4, 5, 9)} == {1}
    none = language_model.score(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.base_score for r in none} == {0.0}
    assert language_model.score(empty(spark, docs), F.lit(True)).count() == 0


def test_filter_never_counts_too_little():
    keys = language_model.mixed(np.arange(1, 5001, dtype=np.uint64))
    counts = 1 + np.arange(5000) % 300
    bits, data = language_model.build_segment(keys, counts, 1 << 20)
    held = language_model.Filter(np.array([bits]), data, 0)
    held.shift = np.uint64(63)  # one segment
    low = keys < np.uint64(1 << 63)
    assert (held.counts(keys[low]) >= 2.0 ** np.floor(np.log2(counts[low]))).all()


def test_personal_data():
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    rng = np.random.default_rng(5)
    alphabet = list("0123456789....@@--+ ()ab\n")
    texts = ["".join(rng.choice(alphabet, 120)) for _ in range(3000)] + ["a@b.c.d@e.f", "@x.y", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (988) 555-2485"]
    for text in texts:
        want = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                right = {"email": lambda: True, "ip": lambda m=m: all(int(p) < 256 for p in m[0].split(".")), "card": lambda d=digits: 12 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15}
                if right[kind]():
                    want.append((*m.span(), kind))
        assert sorted(pii.base_spans(text)) == sorted(want)
    weights = pii.fit(["mail joe@example.com now", "call +1 (988) 555-2485", "card 4111111111111111 x", "ip 10.0.0.1 x"])
    assert pii.find("call (415) 555-2671 now", weights)[1] == [(5, 19, "phone")]
    assert pii.find("nothing 2024-01-02 here", weights)[1] == []
    assert pii.masked("a joe@example.com b", [(2, 17, "email")]) == "a <EMAIL> b"


def test_personal_data_edge_cases(spark, docs):
    found = pii.detect(docs, pii.train(docs)).collect()
    assert len(found) == docs.count() and all(not r.spans for r in found)
    assert [r.masked for r in found if r.doc_id == 5] == [None]


def check_packing(spark, docs):
    coder = Tokenizer.from_file(vocabulary())
    got = packing.pack(docs, vocabulary()).toPandas()
    want = collections.Counter()
    for r in docs.collect():
        want[(r.doc_id, len(coder.encode(r.text or "", add_special_tokens=False).ids) + 1)] += 1
    total = sum(n * k for (_, n), k in want.items())
    assert got.length.sum() == total
    order = got.sort_values(["sequence_id", "offset"])
    assert (order.groupby("sequence_id").length.cumsum() - order.length == order.offset).all()
    lengths = order.groupby("sequence_id").length.sum()
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths) and list(lengths.index) == list(range(len(lengths)))
    return got


def test_packing(spark, docs, small):
    check_packing(spark, docs)
    check_packing(spark, spark.read.parquet(f"{small}/documents.parquet"))
    assert packing.pack(empty(spark, docs), vocabulary()).count() == 0


def test_word_tokenizer_equals_the_whole_one():
    coder, whole = packing.WordTokenizer(vocabulary()), Tokenizer.from_file(vocabulary())
    for text in [PLAIN, "ÉTÉ Straße é ΣΑΣ İx it's 1234 a\tb c <|endoftext|> ###!! \n\nx", LONG[:500], "\x1c\x85 日本語 ｆｕｌｌ"]:
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_of_many_texts_are_looked_up_once():
    coder, whole, asked = packing.WordTokenizer(vocabulary()), Tokenizer.from_file(vocabulary()), []
    ids = coder.ids
    coder.ids = lambda word: asked.append(word) or ids(word)
    texts = ["tea for two", None, "", "two tea\nfor  É", "tea"]
    got, sizes = packing.token_ids(pa.array(texts), coder)
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
    assert sorted(w for w in asked if w) == ["for", "tea", "two", "É"]


def test_capitals_and_marks_make_no_new_words():
    coder, whole, asked = packing.WordTokenizer(vocabulary()), Tokenizer.from_file(vocabulary()), []
    ids = coder.ids
    coder.ids = lambda word: asked.append(word) or ids(word)
    texts = ["Tea tea, TEA. (tea)", "tea42!", "  été, (été\n\n", ""]
    got, sizes = packing.token_ids(pa.array(texts), coder)
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert got.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
    assert sorted(asked) == ["!", "(", ")", ",", ".", "2", "4", "tea", "été"]


def test_ids_of_all_characters_and_contractions_in_words():
    coder, whole = packing.WordTokenizer(vocabulary()), Tokenizer.from_file(vocabulary())
    around = ["{0}", "a{0}", "{0}B", "a{0}{0}b", "1{0}2", "!{0}?", "é{0}É", "'{0}l", "x'{0}'VE", "<|{0}|>"]
    texts = [" ".join(x.format(chr(c)) for x in around) for c in [*range(1, 0x400), 0x2019, 0x212A, 0x65E5, 0xFF46, 0x1F600]]
    texts += ["It's WE'RE you'LL he'd 'twas 'the street's o'clock ''s rock'n'roll", "<|endoftext|> <|EndOfText|> a<|b", "", "\n", " "]
    for some in (texts, texts[1:4], [""], ["", None], []):
        got, sizes = packing.token_ids(pa.array(some, pa.string()), coder)
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in some]
        assert sizes.tolist() == [len(w) for w in want] and got.tolist() == sum(want, [])
    sliced = pa.array(texts).slice(30, 60)
    assert packing.token_ids(sliced, coder)[0].tolist() == sum((whole.encode(t, add_special_tokens=False).ids for t in texts[30:90]), [])


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, small), "test")
        assert docs.columns == names, name
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        if name.startswith("n-gram"):
            classes = brute_classes([(r.doc_id, r.text) for r in before.collect()])
            assert sorted(r.doc_id for r in docs.collect()) == sorted({c for c, _ in classes.values()})
    check_packing(spark, docs)


def test_components_of_nodes_with_many_roots(spark):
    """Nodes that hang on several roots each, in either direction, twice, with loops and chains between roots."""
    rng = np.random.default_rng(3)
    edges = [(int(n), int(r)) for n in range(100, 160) for r in rng.choice(20, 2, replace=False) if n % 3 or r < 10]
    edges += [(r + 200, r + 201) for r in range(12)] + [(5, 5), (300, 301), (301, 300), (300, 301)]
    parent = {n: n for edge in edges if edge[0] != edge[1] for n in edge}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {n: root(n) for n in parent}


def test_language_model_keeps_its_fill_and_counts_as_it_grows(spark):
    """Scores from exact word counts and pair levels; bits grow with the stored pairs and nothing saturates."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(11)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 400, 300))) for k in range(600)] + [(None, "w1 w2"), (600, "never seen")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    fills = {}
    for most in (60, 601):
        got = language_model.score(frame.filter(f"doc_id < {most}"), F.col("doc_id") < 600).collect()
        fills[most] = got[0].filter_fill
    assert all(abs(f - (1 - math.exp(-2 / 8))) < 0.03 for f in fills.values()), fills
    words, pairs = collections.Counter(), collections.Counter()
    for k, t in rows[:600]:
        own = [*t.split(), " end"]
        words.update(own)
        pairs.update(zip([" end", *own[:-1]], own, strict=True))
    n, v = sum(words.values()), len(words)
    p = lambda w: (words[w] + 0.5) / (n + 0.5 * (v + 1))
    scored = {r.doc_id: r for r in language_model.score(frame, F.col("doc_id") < 600).collect()}
    assert len(scored) == len(rows)
    wrong = 0
    for k, t in rows:
        own = [*t.split(), " end"]
        assert math.isclose(scored[k].base_score, sum(math.log10(p(w)) for w in own), abs_tol=1e-6)
        want = 0.0
        for a, b in zip([" end", *own[:-1]], own, strict=True):
            low = 2.0 ** math.floor(math.log2(pairs[a, b])) if pairs[a, b] else 0
            want += math.log10((min(math.sqrt(low * (2 * low - 1)) if low else 0, words[a]) + 10 * p(b)) / (words[a] + 10))
        assert scored[k].score >= want - 1e-6  # an error of the filter can only raise a count
        wrong += abs(scored[k].score - want) / len(own) > 0.05
    assert wrong < 30, wrong


def test_pair_bits_follow_the_entries():
    """No bound on the bits of a segment: unseen keys stay unseen however many are stored."""
    keys = language_model.mixed(np.arange(1, 400_001, dtype=np.uint64)) >> np.uint64(1)  # one segment
    bits, data = language_model.build_segment(keys, np.ones(len(keys), np.int64))
    held = language_model.Filter(np.array([bits]), data, 63)
    unseen = language_model.mixed(np.arange(500_001, 600_001, dtype=np.uint64)) >> np.uint64(1)
    assert bits == 8 * len(keys) and (held.counts(keys) > 0).all() and (held.counts(unseen) > 0).mean() < 0.06


def test_segments_follow_the_tokens(spark, docs, monkeypatch):
    from pyspark.sql import functions as F

    assert [language_model.segments_for(n) for n in (0, 1, 1 << 28, (1 << 28) + 1, 5 * 10**9)] == [256, 256, 256, 512, 8192]
    few = {r.doc_id: tuple(r)[:5] for r in language_model.score(docs, F.lit(True)).collect()}
    monkeypatch.setattr(language_model, "TOKENS_A_SEGMENT", 16)
    assert language_model.segments_for(30_000) == 2048
    many = {r.doc_id: tuple(r)[:5] for r in language_model.score(docs, F.lit(True)).collect()}
    assert few == many


def test_classifier_bounds_its_rows_when_ids_repeat(spark, monkeypatch):
    """An id on most rows takes one row of the sample a label; labels with higher ids teach as well."""
    rows = [(0, PLAIN + " x" * k) for k in range(300)] + [(k, PLAIN + " y" * k) for k in range(1, 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(3, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda x, y: seen.append((x, y)))
    quality_classifier.train(frame, labels, sample=21)
    (x, y), = seen
    assert len(y) == 21 and y.sum() == 11
    want = np.mean([quality_classifier.statistics(t) for k, t in rows if k == 0], 0)
    assert np.isclose(x, want).all(1).sum() == 1
    assert sum(np.allclose(r, quality_classifier.statistics(rows[302][1])) for r in x) == 2  # labelled twice


def test_near_duplicates_with_null_and_repeated_ids(spark, small):
    """One row of each group stays: groups of null ids, a null beside an id, one id on near-equal and on other texts."""
    long = [" ".join(f"{name}{k}" for k in range(100)) for name in "abcd"]
    rows = [
        (None, long[0]), (None, long[0] + " more"), (None, long[0]),
        (None, long[1]), (9, long[1] + " more"), (9, long[1] + " again"), (9, long[1] + " more"),
        (5, long[2]), (5, long[2] + " more"), (5, long[3]), (7, long[3] + " more"),
        (None, ""), (None, ""), (4, None), (3, ""), (3, ""),
    ]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), small).collect()]
    count = lambda name: [k for k, t in got if t and t.startswith(name + "0 ")]
    assert (count("a"), count("b"), count("c"), count("d")) == ([None], [9], [5], [5])
    assert sorted(str(k) for k, t in got if not t) == ["3", "4", "None", "None"]


def test_word_hashes_of_a_worker_stay_few():
    """Workers serve all stages of the pipeline, so what one keeps is held beside the next stage's memory."""
    shingles = ngram_join.Shingles()
    texts = [" ".join(f"w{k}" for k in range(at, at + 5_000)) for at in range(0, 120_000, 5_000)]
    first = [shingles(t) for t in texts]
    assert len(shingles.known) <= 60_000
    assert all((shingles(t) == f).all() for t, f in zip(texts, first, strict=True))
