"""ROUGE-L: longest common subsequence of stemmed tokens.

The subsequence is found by bit-parallel dynamic programming: a row of the
table is one integer, so a token of one side costs a few operations on as many
bits as the other side has tokens. Scores come in Arrow batches. A form in
higher-order functions alone is kept for plans that must stay in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[a-z0-9]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        match = places.get(y, 0) & row
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def f1(reference: list, prediction: list) -> float:
    common = lcs_length(reference, prediction) if reference and prediction else 0
    if not common:
        return 0.0
    p, r = common / len(prediction), common / len(reference)
    return 2 * p * r / (p + r)


# --- Porter's stemmer (1980), written from the paper's rules ---------------

_VOWELS = "aeiou"
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _consonant(word: str, i: int) -> bool:
    if word[i] in _VOWELS:
        return False
    return word[i] != "y" or i == 0 or not _consonant(word, i - 1)


def _measure(stem: str) -> int:
    kinds = "".join("c" if _consonant(stem, i) else "v" for i in range(len(stem)))
    return len(re.findall("v+c", kinds))


def _has_vowel(stem: str) -> bool:
    return any(not _consonant(stem, i) for i in range(len(stem)))


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _consonant(word, len(word) - 1)


def _cvc(word: str) -> bool:
    n = len(word)
    return n > 2 and _consonant(word, n - 3) and not _consonant(word, n - 2) and _consonant(word, n - 1) and word[-1] not in "wxy"


def _swap(word: str, endings: dict) -> str:
    """The longest ending that fits is replaced where its stem is long enough."""
    for end in sorted(endings, key=len, reverse=True):
        if word.endswith(end):
            stem = word[: -len(end)]
            return stem + endings[end] if _measure(stem) > 0 else word
    return word


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    # 1a: plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # 1b: past and gerund
    cut = False
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for end in ("ed", "ing"):
            if word.endswith(end) and _has_vowel(word[: -len(end)]):
                word, cut = word[: -len(end)], True
                break
    if cut:
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif _double(word) and word[-1] not in "lsz":
            word = word[:-1]
        elif _measure(word) == 1 and _cvc(word):
            word += "e"
    # 1c
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, _STEP2), _STEP3)
    # 4
    for end in sorted(_STEP4, key=len, reverse=True):
        if word.endswith(end):
            rest = word[: -len(end)]
            if _measure(rest) > 1 and (end != "ion" or rest.endswith(("s", "t"))):
                word = rest
            break
    # 5
    if word.endswith("e"):
        rest = word[:-1]
        if _measure(rest) > 1 or (_measure(rest) == 1 and not _cvc(rest)):
            word = rest
    if _measure(word) > 1 and _double(word) and word.endswith("l"):
        word = word[:-1]
    return word


def _stemmed(text: str | None) -> list[str]:
    # short tokens are left as they are, as in the usual scorer
    return [stem(t) if len(t) > 3 else t for t in tokens(text)]


def _scorer(read):
    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for reference, prediction in parts:
            yield pd.Series([f1(read(r), read(p)) for r, p in zip(reference, prediction)], dtype="float64")

    return score


def rouge_l(reference: Column, prediction: Column, stemmed: bool = True) -> Column:
    return _scorer(_stemmed if stemmed else tokens)(reference, prediction)


def rouge_l_native(reference: Column, prediction: Column) -> Column:
    """The same without stems, in higher-order functions only."""
    split = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    a, b = split(reference), split(prediction)

    def row(previous, y):
        def cell(done, k):
            left = F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))
            diagonal = F.when(k > 0, F.get(previous, k - 1)).otherwise(F.lit(0))
            best = F.when(F.get(a, k) == y, diagonal + 1).otherwise(F.greatest(left, F.get(previous, k)))
            return F.concat(done, F.array(best))

        return F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), F.array().cast("array<int>"), cell)

    start = F.transform(a, lambda _: F.lit(0))
    common = F.when((F.size(a) > 0) & (F.size(b) > 0), F.try_element_at(F.aggregate(b, start, row), F.lit(-1))).otherwise(F.lit(0))
    p, r = common / F.size(b), common / F.size(a)
    return F.when(common > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
