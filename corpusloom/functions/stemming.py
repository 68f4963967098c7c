"""Porter's stemmer (1980), with the two usual departures of step 2 (bli, logi) that later versions have."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.shipping import ship

#: Suffixes and what replaces them, in the order of the published steps.
STEP2 = dict(x.split(":") for x in "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble logi:log".split())
STEP3 = dict(x.split(":") for x in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split())
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _consonants(word: str) -> list[bool]:
    out: list[bool] = []
    for k, c in enumerate(word):
        out.append(c not in "aeiou" and not (c == "y" and k > 0 and out[-1]))
    return out


def _measure(stem: str) -> int:
    kinds = _consonants(stem)
    return sum(not a and b for a, b in zip(kinds, kinds[1:], strict=False))


def _has_vowel(stem: str) -> bool:
    return not all(_consonants(stem))


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _consonants(word)[-1]


def _short(word: str) -> bool:
    return len(word) > 2 and _consonants(word)[-3:] == [True, False, True] and word[-1] not in "wxy"


def _replace(word: str, table: dict[str, str]) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + table[suffix] if _measure(stem) > 0 else word
    return word


def stem(word: str) -> str:
    word = word.lower()
    if len(word) <= 2:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix) and _has_vowel(word[: -len(suffix)]):
                word = word[: -len(suffix)]
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif _double(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short(word):
                    word += "e"
                break
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(_replace(word, STEP2), STEP3)
    for suffix in sorted(STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            if _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))):
                word = rest
            break
    if word.endswith("e") and (_measure(word[:-1]) > 1 or (_measure(word[:-1]) == 1 and not _short(word[:-1]))):
        word = word[:-1]
    return word[:-1] if _measure(word) > 1 and _double(word) and word.endswith("l") else word


def _stems(column: pd.Series) -> pd.Series:
    known: dict[str, str] = {}
    return column.map(lambda words: [known.get(w) or known.setdefault(w, stem(w)) for w in words])


def stems(tokens: Column) -> Column:
    """Stems of an array of tokens."""
    if session := SparkSession.getActiveSession():
        ship(session)

    def run(column: pd.Series) -> pd.Series:
        return _stems(column)

    return F.pandas_udf(run, "array<string>")(F.coalesce(tokens, F.expr("cast(array() as array<string>)")))
