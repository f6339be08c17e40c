"""Literal cases of the text, key, genre and page functions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain import fixed
from refrain.functions import stemming
from refrain.functions.keys import canon_title, with_artist_key, with_lyric_url, with_name_keys
from refrain.functions.stemming import stem, stem_array, stem_word
from refrain.functions.text import clean_scraped, dash_key, decade, normalise, tokens
from refrain.operators.genre import (
    add_others,
    clean_genre,
    extract_genre,
    extraction_report,
    genre_fallback,
    genre_flags,
    genre_long,
    select_range,
)
from refrain.sources.html import html_tables, html_text, name_cells
from refrain.sources.status import parsed_rows, split_ok_failed, with_status, write_by_status


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, words",
    [
        ("Don't stop, rock 'n' roll!", ["don't", "stop", "rock", "n", "roll"]),
        ("It’s 3.5 o'clock", ["it's", "3", "5", "o'clock"]),
        ("", []),
        ("Été à l'ombre", ["été", "à", "l'ombre"]),
    ],
)
def test_tokens(spark, text, words):
    assert one(spark, text, tokens) == words


def test_cleaning(spark):
    assert one(spark, '\n a "b"\r\nc \t', clean_scraped) == "a b c"
    assert one(spark, '"Gypsys, Tramps & Thieves"', dash_key) == "Gypsys-Tramps-Thieves"
    assert one(spark, "Don't  STOP - now!", normalise) == "dont stop now"


@pytest.mark.parametrize(
    "year, label",
    [(1968, "1960s"), (1969, "1960s"), (1970, "1970s"), (1989, "1980s"), (2017, "2010s"), (2018, "1960s"), (None, "1960s")],
)
def test_decade_edges(spark, year, label):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(decade(F.col("y"))).first()[0] == label


def test_title_aliases(spark):
    def title(text, mode):
        return one(spark, text, lambda c: canon_title(c, mode=mode))

    assert title("Jumpin' Jack Flash", "literal") == "jumpingjackflash"
    # As a pattern the bracketed alias matches the text without brackets.
    assert title("Habits Stay High", "regex") == "habits"
    assert title("Habits (Stay High)", "literal") == "habits"
    assert title("Habits (Stay High)", "regex") == "habitsstayhigh"


@pytest.mark.parametrize(
    "artist, literal, regex",
    [
        ("Ann Featuring Bob", "ann", None),
        ("Ann featuring Bob", "ann", None),
        ("Ann with Bob", "ann", None),
        ("The Beatles", "beatles", None),
        ("Ann & Bob", "annbob", None),
        ("A-ha", "aha", None),
        ("Ann x Bob", "ann", None),
        ("Ann + Bob", "ann", "annbob"),
        ("Ann  Bob", "annbob", "ann"),
        ("Mr. Big!", "mrbig", None),
        ("Jay and the Americans", "jaytheamericans", None),
        ("The Game featuring 50 Cent", "game", None),
    ],
)
def test_artist_branches(spark, artist, literal, regex):
    df = spark.createDataFrame([(artist,)], "a string")
    for mode, want in (("literal", literal), ("regex", regex or literal)):
        assert with_artist_key(df, "a", "k", mode=mode).first()["k"] == want


def test_keys_are_stable(spark):
    df = spark.createDataFrame([("Ann Featuring Bob",), ("Mr. Big!",)], "a string")
    once = with_artist_key(df, "a", "k")
    assert once.select("k").collect() == with_artist_key(once.select("k"), "k", "k2").select("k2").collect()


def test_name_keys_equal_those_of_each_row(spark):
    """Aliases with special characters, two aliases in one name, each branch, null and empty names."""
    titles = [p for p, _ in fixed.TITLE_ALIASES] + ["Diary of Mr. Brightside", "plain", "", None]
    artists = [p for p, _ in fixed.ARTIST_ALIASES] + ["a Featuring b", "a with b", "The x & y", "a-b", "a x b", "a + b", "", None]
    names = spark.createDataFrame([(t, a) for t in titles for a in artists[::5] + artists[-8:]], "t string, a string")
    for mode in ("literal", "regex"):
        got = with_name_keys(names, "t", "a", mode=mode).select("t", "a", "title_key", "artist_key")
        want = with_artist_key(names.withColumn("title_key", canon_title(F.col("t"), mode=mode)), "a", "artist_key", mode=mode)
        assert Counter(got.collect()) == Counter(want.collect())


def test_lyric_url(spark):
    df = spark.createDataFrame([("Hey Jude", "The Beatles")], "t string, a string")
    assert with_lyric_url(df, "t", "a").first()["lyrics_url"].endswith("/beatles/heyjude.html")


@pytest.mark.parametrize(
    "word, want",
    [
        ("consign", "consign"), ("consigned", "consign"), ("consistency", "consist"), ("consolatory", "consolatori"),
        ("consolidating", "consolid"), ("consolingly", "consol"), ("conspicuously", "conspicu"), ("conspiracy", "conspiraci"),
        ("knackeries", "knackeri"), ("knavish", "knavish"), ("kneaded", "knead"), ("knightly", "knight"), ("knitting", "knit"),
        ("knots", "knot"), ("generous", "generous"), ("generic", "generic"), ("communism", "communism"), ("arsenal", "arsenal"),
        ("caresses", "caress"), ("ties", "tie"), ("cries", "cri"), ("gas", "gas"), ("this", "this"), ("gaps", "gap"), ("kiwis", "kiwi"),
        ("luxuriated", "luxuri"), ("hopped", "hop"), ("hoped", "hope"), ("agreed", "agre"), ("feed", "feed"), ("cry", "cri"),
        ("by", "by"), ("say", "say"), ("skies", "sky"), ("dying", "die"), ("only", "onli"), ("news", "news"), ("innings", "inning"),
        ("succeeding", "succeed"), ("youth", "youth"), ("boyish", "boyish"), ("bestially", "bestial"), ("analogies", "analog"),
        ("adoption", "adopt"), ("relational", "relat"), ("formative", "format"), ("controll", "control"), ("roll", "roll"), ("rate", "rate"),
    ],
)
def test_published_stems(word, want):
    assert stem_word(word) == want


def test_stem_columns(spark):
    df = spark.createDataFrame([(["ponies", "sky"],), ([],), (None,)], "w array<string>")
    assert [r[0] for r in df.select(stem_array("w")).collect()] == [["poni", "sky"], [], None]
    words = spark.createDataFrame([("ponies",), (None,)], "w string")
    assert [r[0] for r in words.select(stem("w")).collect()] == ["poni", None]


@pytest.mark.parametrize(
    "text, want",
    [
        ("a (b (c) d) Rock 'n' Roll", "a-Rock-and-Roll"),
        ("Rock & the Soul", "Rock-and-Soul"),
        ("Easy listening, singin'", "Easy-listenin-sinin"),
        ("R&B", "RandB"),
    ],
)
def test_genre_clean(spark, text, want):
    assert one(spark, text, clean_genre) == want


def test_genre_extraction_branches(spark):
    rows = [
        (1, "x-Genre-Pop-Length-3", "T"),
        (2, "my-song-by-Genres-Rock", "My-Song"),
        (3, "other-Genre-Pop", "Zz"),
        (4, "nothing", "T"),
        (5, None, "T"),
    ]
    df = spark.createDataFrame(rows, "id int, raw string, title string")
    got = {r["id"]: r["genre"] for r in extract_genre(df, "raw", "title").collect()}
    assert got == {1: "-Pop-", 2: "Rock", 3: fixed.EXTRACTION_FAILED, 4: fixed.NO_GENRE, 5: fixed.NO_GENRE}
    report = {r["genre"]: r["n"] for r in extraction_report(extract_genre(df, "raw", "title")).collect()}
    assert report == {fixed.EXTRACTION_FAILED: 1, fixed.NO_GENRE: 2}


def test_genre_fallback(spark):
    rows = [
        (1, "wiki Wikipediahttp://aCached", fixed.NO_GENRE),
        (2, "wiki Wikipediahttp://bCached", fixed.NO_GENRE),
        (3, "wiki Wikipediahttp://cCached", fixed.NO_GENRE),
        (4, "plain", fixed.NO_GENRE),
        (5, "wiki Wikipediahttp://aCached", "Pop"),
        (6, None, fixed.NO_GENRE),
    ]
    df = spark.createDataFrame(rows, "id int, genre_raw string, genre string")
    lines = [("http://a", 2, "Genres\nSoul"), ("http://a", 1, "xGenreRock"), ("http://a", 3, "Label"), ("http://b", 1, "no")]
    pages = spark.createDataFrame(lines, "url string, pos int, text string")
    got = {r["id"]: r["genre"] for r in genre_fallback(df, pages).collect()}
    assert got == {1: "Rock Soul", 2: fixed.NO_GENRE, 3: fixed.PAGE_MISSING, 4: fixed.NO_GENRE, 5: "Pop", 6: fixed.NO_GENRE}


def test_flags_match_inside_words(spark):
    rows = [(1, "Brandy-trap"), (2, "Rhythm-and-blues"), (3, "Hip hop"), (4, None), (5, "Novelty")]
    df = add_others(genre_flags(spark.createDataFrame(rows, "id int, genre string")), fixed.GENRES)
    flags = {r["id"]: {g for g in [*fixed.GENRES, "others"] if r[g] == 1} for r in df.collect()}
    assert flags == {1: {"RandB", "rap"}, 2: {"blues", "RandB"}, 3: {"hiphop"}, 4: {"others"}, 5: {"others"}}
    assert select_range(df, "pop", "metal") == fixed.GENRES


def test_long_form_goes_back_to_the_flags(spark):
    rows = [(1, "Pop-rock"), (2, "Soul"), (3, "none")]
    df = genre_flags(spark.createDataFrame(rows, "id int, genre string")).drop("genre")
    wide = genre_long(df, fixed.GENRES).groupBy("id").pivot("genre_tidy", fixed.GENRES).count().na.fill(0)
    want = df.filter("pop + rock + soul > 0").orderBy("id").collect()
    assert [tuple(map(int, r)) for r in wide.orderBy("id").collect()] == [tuple(r) for r in want]


PAGE = """<html><body><div id="content"><div>
<table><tr><td>first</td></tr></table>
<table><tr><th>No.</th><th>Title</th><th>Artist</th></tr>
<tr><td>1</td><td>"A &amp; B"</td><td>Ann<br></td></tr>
<tr><td rowspan="2">Tie</td><td>C</td><td><table><tr><td>inner</td></tr></table></td></tr>
<tr><td>D</td></tr>
<tr><td colspan=2>E</td></tr></table></div></div>
<p>one<p>two <b>bold</b></p></body></html>"""


def test_html_tables(spark):
    pages = spark.createDataFrame([(7, PAGE), (8, None), (9, "<p>no table")], "k int, html string")
    rows = html_tables(pages, "k", which=-1, path=["#content", "div"]).orderBy("row_no").collect()
    assert [(r["k"], r["table_no"], r["cells"]) for r in rows] == [
        (7, 1, ["1", '"A & B"', "Ann"]),
        (7, 1, ["Tie", "C", "inner"]),
        (7, 1, ["Tie", "D", None]),
        (7, 1, ["E", "E", None]),
    ]
    assert html_tables(pages, "k").select("table_no").distinct().count() == 3
    named = name_cells(html_tables(pages, "k", which=0), ["a", "b"]).first()
    assert (named["a"], named["b"]) == ("first", None)


def test_html_text(spark):
    pages = spark.createDataFrame([(7, PAGE)], "k int, html string")
    got = [(r["pos"], r["text"].strip()) for r in html_text(pages, "k", "p").collect()]
    assert got == [(1, "one"), (2, "two bold")]
    assert html_text(pages, "k", "p", index=2).first()["text"] == "two bold"


def test_parse_status(spark):
    df = spark.createDataFrame([("1",), ("x",), ("99",), (None,)], "raw string")
    out = with_status(df, "raw", F.col("raw").try_cast("int"), suspicious=F.col("value") > 90)
    assert {r["raw"]: r["status"] for r in out.collect()} == {"1": "ok", "x": "Error!", "99": "Warning!", None: "ok"}
    ok, failed = split_ok_failed(out)
    assert (ok.count(), failed.count()) == (2, 2)


def test_spans_are_bounded():
    from refrain.sources.html import _tables

    page = '<table><tr><td colspan=99999999999>A</td><td colspan="²">B</td></tr></table>'
    ((_, _, _, cells),) = _tables(page, [])
    assert cells == ["A"] * 1000 + ["B"]


def test_failed_rows_keep_their_message(spark, tmp_path):
    def parse(text):
        if text == "odd":
            raise Warning("suspicious", "kept")
        return str(1 // int(text))

    df = spark.createDataFrame([(1, "1"), (2, "x"), (3, "0"), (4, None), (5, "odd")], "id int, raw string")
    parsed = parsed_rows(df, "raw", parse)
    got = {r["id"]: (r["value"], r["status"], r["message"]) for r in parsed.collect()}
    assert got[1] == ("1", "ok", None) and got[4] == (None, "missing", None) and got[5] == ("kept", "Warning!", "suspicious")
    assert got[2][:2] == got[3][:2] == (None, "Error!") and "'x'" in got[2][2] and "zero" in got[3][2]
    assert write_by_status(parsed, f"{tmp_path}/out") == {"ok": 1, "Warning!": 1, "Error!": 2, "missing": 1}
    assert parsed_rows(df.limit(0), "raw", parse).count() == 0


def test_frequent_words_are_stemmed_once_per_worker():
    words = np.array([f"{w}ing" for w in ("sing", "walk", "zorbl")] * 50 + [None], dtype=object)
    stemming._stem_each(words)
    before = stemming.stem_word.cache_info()
    assert stemming._stem_each(words).tolist() == ["sing", "walk", "zorbl"] * 50 + [None]
    after = stemming.stem_word.cache_info()
    assert after.misses == before.misses and after.maxsize is not None


def test_longest_ending():
    assert stemming._ending("rationalization", stemming.FIRST_RULES) == "ization"
    assert stemming._ending("li", stemming.FIRST_RULES) == "li" and stemming._ending("", stemming.LAST) == ""
