"""Linguistic chunks: sentence fragments, pieces of long fragments, and chunks that pack them.

The work is a fold over one text, so it runs in an Arrow UDF; long texts stay linear in time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.shipping import ship

#: Abbreviations whose full stop ends no sentence, and words before which a comma may split.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St", "vs", "etc", "e.g", "i.e", "U.S", "U.K", "a.m", "p.m")
CONNECTORS = ("and", "but", "or", "because", "which", "that", "who", "while", "although", "however", "so", "then", "if", "when")

_DOT = "\ue000"
_GUARDS = (
    re.compile(r"\b(?:" + "|".join(map(re.escape, ABBREVIATIONS)) + r")\.", re.I),
    re.compile(r"\b(?:[A-Z]\.){2,}", re.I),
    re.compile(r"\d\.\d"),
)
_ENDS = re.compile(r"[.!?][\"')\]]*(?=\s|$)")
_CUTS = (re.compile(r"(?<=[;:])\s+"), re.compile(r"(?<=,)\s+(?=(?:" + "|".join(CONNECTORS) + r")\b)", re.I), re.compile(r"(?<=[)\]\"'])\s+"))


def sentence_fragments(text: str | None) -> list[str]:
    """Sentences with their closing marks, paragraph by paragraph; dots of abbreviations, initials and decimals hold."""
    text = (text or "").strip()
    for guard in _GUARDS:
        text = guard.sub(lambda m: m[0].replace(".", _DOT), text)
    out = []
    for paragraph in re.split(r"\n{2,}", text):
        line, start = re.sub(r"\s*\n+\s*", " ", paragraph).strip(), 0
        for end in [m.end() for m in _ENDS.finditer(line)] + [len(line)]:
            if end > start:
                out.append(line[start:end].strip().replace(_DOT, "."))
                start = end
    return [x for x in out if x]


def packed(parts: Iterable[str], limit: int) -> list[str]:
    """Neighbours joined by a blank as long as they stay within the limit."""
    out: list[str] = []
    for part in parts:
        if out and len(out[-1]) + 1 + len(part) <= limit:
            out[-1] += f" {part}"
        else:
            out.append(part)
    return out


def long_fragment_pieces(text: str | None, limit: int) -> list[str]:
    """Pieces at the first kind of cut that makes all fit, unpacked if they fit as they are; else packed words."""
    text = " ".join((text or "").split())
    if not text:
        return []
    for cut in _CUTS:
        parts = [p for p in map(str.strip, cut.split(text)) if p]
        if len(parts) > 1:
            for candidate in (parts, packed(parts, limit)):
                if all(len(p) <= limit for p in candidate):
                    return candidate
    return packed(text.split(" "), limit)


def chunks_of(text: str | None, limit: int) -> list[str]:
    """Chunks of at most `limit` characters, unless one word is longer."""
    fragments = sentence_fragments(text)
    return packed((p for f in fragments for p in ([f] if len(f) <= limit else long_fragment_pieces(f, limit))), limit)


def _udf(function, *arguments):
    if session := SparkSession.getActiveSession():
        ship(session)

    @F.pandas_udf("array<string>")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: function(t, *arguments))

    return run


def fragments_column(c: Column) -> Column:
    return _udf(sentence_fragments)(F.coalesce(c, F.lit("")))


def chunks_column(c: Column, limit: int = 500) -> Column:
    return _udf(chunks_of, limit)(F.coalesce(c, F.lit("")))


def pieces_column(c: Column, limit: int = 500) -> Column:
    return _udf(long_fragment_pieces, limit)(F.coalesce(c, F.lit("")))
