"""English stems by the Porter2 rules, for words that Spark hands over in Arrow batches.

R1 is what follows the first vowel and the non-vowel after it, R2 the same within R1. A step takes the longest ending of
its list and changes it only if the ending lies in the region its rule names. A ``y`` that acts as a consonant is
written ``Y`` meanwhile.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word lists and endings of the published algorithm.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
REGION_STARTS = ["gener", "commun", "arsen"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
LI_ENDINGS = "cdeghkmnrt"
# In R1; the letters an ending must follow, if any, come third.
SUFFIXES = [
    ("tional", "tion", ""), ("enci", "ence", ""), ("anci", "ance", ""), ("abli", "able", ""), ("entli", "ent", ""),
    ("izer", "ize", ""), ("ization", "ize", ""), ("ational", "ate", ""), ("ation", "ate", ""), ("ator", "ate", ""),
    ("alism", "al", ""), ("aliti", "al", ""), ("alli", "al", ""), ("fulness", "ful", ""), ("ousli", "ous", ""),
    ("ousness", "ous", ""), ("iveness", "ive", ""), ("iviti", "ive", ""), ("biliti", "ble", ""), ("bli", "ble", ""),
    ("ogi", "og", "l"), ("fulli", "ful", ""), ("lessli", "less", ""), ("li", "", LI_ENDINGS),
]
# In R1, "ative" in R2.
SECOND_SUFFIXES = [
    ("tional", "tion"), ("ational", "ate"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""), ("ative", ""),
]
# In R2, "ion" after s or t.
LAST_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive",
    "ize", "ion",
]

VOWEL = re.compile("[aeiouy]")
REGION = re.compile("[^aeiouy]*[aeiouy]+[^aeiouy]")
START = re.compile("|".join(REGION_STARTS))
SHORT_END = re.compile("[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$")
PAST = dict.fromkeys(["eedly", "ingly", "edly", "eed", "ing", "ed"])
FIRST_RULES, SECOND_RULES, LAST = {s: rest for s, *rest in SUFFIXES}, dict(SECOND_SUFFIXES), dict.fromkeys(LAST_SUFFIXES)
KEPT_WORDS = 200_000  # stems a Python worker remembers


def _ending(word: str, endings: dict) -> str:
    """The longest of the endings that the word has, or an empty text."""
    for begin in range(-7, 0):
        if word[begin:] in endings:
            return word[begin:]
    return ""


def regions(word: str) -> tuple[int, int]:
    """Where R1 and R2 begin; the word's length if they are empty."""
    begin = START.match(word) or REGION.match(word)
    if begin is None:
        return len(word), len(word)
    within = REGION.match(word, begin.end())
    return begin.end(), within.end() if within else len(word)


def _past(word: str, r1: int) -> str:
    found = _ending(word, PAST)
    if not found:
        return word
    rest = word[: -len(found)]
    if found.startswith("eed"):
        return f"{rest}ee" if len(rest) >= r1 else word
    if not VOWEL.search(rest):
        return word
    if rest.endswith(("at", "bl", "iz")):
        return f"{rest}e"
    if rest[-2:] in DOUBLES:
        return rest[:-1]
    return f"{rest}e" if r1 >= len(rest) and SHORT_END.search(rest) else rest


@lru_cache(KEPT_WORDS)
def stem_word(word: str) -> str:
    """The stem of a lower-case word; the words last met are remembered, since frequent ones come in every batch."""
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    word = word.removeprefix("'")
    if "y" in word:
        word = re.sub("^y|(?<=[aeiouy])y", "Y", word)
    r1, r2 = regions(word)
    if "'" in word:
        word = re.sub("('s'|'s|')$", "", word)

    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and VOWEL.search(word[:-2]):
        word = word[:-1]
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past(word, r1)
    if len(word) > 2 and word[-1] in "yY" and not VOWEL.match(word[-2]):
        word = f"{word[:-1]}i"

    if (found := _ending(word, FIRST_RULES)) and len(word) - len(found) >= r1:
        rest, (new, after) = word[: -len(found)], FIRST_RULES[found]
        if not after or rest[-1:] in tuple(after):
            word = rest + new
    if (found := _ending(word, SECOND_RULES)) and len(word) - len(found) >= (r2 if found == "ative" else r1):
        word = word[: -len(found)] + SECOND_RULES[found]
    if (found := _ending(word, LAST)) and len(word) - len(found) >= r2:
        rest = word[: -len(found)]
        if found != "ion" or rest.endswith(("s", "t")):
            word = rest

    if word.endswith("e"):
        if len(word) > r2 or (len(word) > r1 and not SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) > r2:
        word = word[:-1]
    return word.replace("Y", "y")


def _stem_each(words: np.ndarray) -> np.ndarray:
    """Stem a batch; every distinct word of the batch is stemmed once."""
    codes, distinct = pd.factorize(words, use_na_sentinel=True)
    stems = np.array([stem_word(w) for w in distinct] + [None], dtype=object)
    return stems[codes]


@F.pandas_udf(T.StringType())
def stem(words: pd.Series) -> pd.Series:
    """Stem a word column."""
    return pd.Series(_stem_each(words.to_numpy(dtype=object)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_array(lists: pa.Array) -> pa.Array:
    """Stem every word of an array column, keeping order and length; no word becomes a Python string twice in a batch."""
    words = lists.flatten().dictionary_encode()
    stems = pa.array([stem_word(w) for w in words.dictionary.to_pylist()], pa.string())
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int32)
    offsets = pa.array(np.concatenate([np.zeros(1, np.int32), ends]))
    return pa.ListArray.from_arrays(offsets, stems.take(words.indices), mask=lists.is_null())
