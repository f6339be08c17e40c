"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are runs of characters other than space and 0x09-0x0D. A threshold bounds ``100 * part / whole`` with
integers, so that the verdict does not depend on rounding. All counts are taken inside the row from the whole
text; nothing is shuffled. Windows of three words are compared through their 64-bit hash.

Edge cases: a null text counts as empty; a text without words has zero counts and fails the length rule; a
threshold whose whole is zero holds; rows that repeat are judged each; an empty table stays empty. Columns
outside ``keep`` and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages of the test tables.
STOP_WORDS = (
    "the of and to in is was for that with on as at by it this are from an or be "
    "de la le les des et un une en du est pour que dans "
    "der die und das den von zu mit ist ein eine nicht "
    "el los las por con su es se del"
).split()


class Threshold(NamedTuple):
    """Keep a text only if ``least <= 100 * part / whole <= most``; None leaves a side open."""

    part: str
    whole: str
    least: int | None
    most: int | None


THRESHOLDS = (
    Threshold("word_chars", "n_words", 200, 1500),
    Threshold("n_symbols", "n_words", None, 20),
    Threshold("n_marks", "n_words", None, 25),
    Threshold("n_stop_words", "n_words", 4, None),
    Threshold("n_dup_lines", "n_lines", None, 50),
    Threshold("n_repeat_words", "n_words", None, 50),
)
MIN_WORDS = 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more.

    The sorted hashes tell which windows repeat. If these are few, windows that are none of them leave first;
    the rest is sorted with its positions and each window compared with its neighbours.
    """

    def at_positions(windows: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(windows, k - 1)["h"])
            after = F.get(windows, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        at = F.sort_array(F.transform(F.filter(windows, repeated), lambda x: x["i"]))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"))
        return F.aggregate(at, zero, step, lambda a: a["n"])

    def of_hashes(hashes: Column) -> Column:
        def of_twice(twice: Column) -> Column:
            few = F.size(twice) <= 16
            pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            left = F.filter(pairs, lambda x: ~few | F.array_contains(twice, x["h"]))
            return F.when(F.size(twice) == 0, F.lit(0).cast("long")).otherwise(_let(F.sort_array(left), at_positions))

        same = lambda ordered: F.filter(ordered, lambda h, k: (k > 0) & (F.get(ordered, k - 1) == h))
        return _let(_let(F.sort_array(hashes), same), of_twice)

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 4, _let(hashes, of_hashes)).otherwise(F.lit(0).cast("long"))


def _of_words(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeat_words(words).alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def _of_lines(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def text_counts(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts that thresholds can name, all long."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))
    with_word = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    without = lambda chars: F.length(body) - F.length(F.regexp_replace(body, chars, ""))
    counted = docs.select(
        *keep,
        _let(words, _of_words).alias("_words"),
        _let(with_word, _of_lines).alias("_lines"),
        without(f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
        without("!").cast("long").alias("n_marks"),
    )
    return counted.select(*keep, "_words.*", "_lines.*", "n_symbols", "n_marks")


def compiled(thresholds: Sequence[Threshold]) -> Column:
    """One boolean expression: true if every threshold holds."""
    verdict = F.lit(True)
    for t in thresholds:
        part, whole = 100 * F.col(t.part), F.col(t.whole)
        if t.least is not None:
            verdict = verdict & (part >= t.least * whole)
        if t.most is not None:
            verdict = verdict & (part <= t.most * whole)
    return verdict


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    thresholds: Sequence[Threshold] = THRESHOLDS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``keep``, all counts, ``base_failed`` (too short or half of its words repeat) and ``kept``."""
    counted = text_counts(docs, text, keep)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumns({"base_failed": failed, "kept": ~failed & compiled(thresholds)})
