"""Text functions as Column expressions. `W` is the Unicode word character class; Java's own \\w and \\b are not used, as
their idea of a word differs from that of the rules implemented here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

W = r"\p{L}\p{N}_"
NOT_IN_WORD, WORD_ENDS = rf"(?<![{W}])", rf"(?![{W}])"
EDGE = rf"(?:(?<=[{W}])(?![{W}])|(?<![{W}])(?=[{W}]))"

#: Words that mark English text.
ENGLISH_WORDS = (
    "the and or but with without from this that these those have has had feel feeling felt my your their because what when where"
    " why how not don't can't won't i me you he she they we is are was were"
).split()
#: Candidate names of a translation column, in order of preference.
TRANSLATION_COLUMNS = ("translate", "translation", "statement_es", "statement_translate", "statement_spanish")
#: The class labels, in report order.
LABELS = ("Anxiety", "Bipolar", "Depression", "Normal", "Personality disorder", "Stress", "Suicidal")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space, of all Unicode, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s++|(?<!\s)\s++$", "")  # a run inside is searched from its first character only


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(?<!\s)\s++$", "")


def is_blank(c: Column) -> Column:
    """Null, empty or white space only: a pending cell."""
    return ~text_or_empty(c).rlike(r"(?U)\S")


def compact(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def count_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"[{W}]+"))


def count_sentences(c: Column) -> Column:
    """Parts between runs of . ! ? that are not blank."""
    return F.regexp_count(c, F.lit(r"(?U)[^.!?\s][^.!?]*+"))


def english_ratio(c: Column) -> Column:
    """Share of ENGLISH_WORDS in the runs of ASCII letters and apostrophes; 0 without such runs."""
    tokens = F.transform(F.regexp_extract_all(c, F.lit("[A-Za-z']+"), F.lit(0)), F.lower)
    hits = F.size(F.filter(tokens, lambda t: t.isin(ENGLISH_WORDS)))
    return F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]++", ""))


def spacing_is_low(c: Column) -> Column:
    """Long tokens on average, or hardly a blank for the letters of a text of eight tokens or more."""
    tokens, alpha = F.regexp_count(c, F.lit(r"(?U)\S++")), letters(c)
    return F.when(tokens == 0, F.lit(False)).otherwise((alpha / tokens >= 9.5) | ((tokens >= 8) & ((tokens - 1) / F.greatest(alpha, F.lit(1)) <= 0.085)))


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def urls(c: Column) -> Column:
    return F.array_distinct(F.transform(_all(c, r"(?U)https?://\S+|www\.\S+"), F.lower))


def years(c: Column) -> Column:
    return F.array_distinct(_all(c, rf"{NOT_IN_WORD}(?:19|20)\p{{Nd}}{{2}}{WORD_ENDS}"))


def numbers(c: Column) -> Column:
    return F.array_distinct(_all(c, rf"{NOT_IN_WORD}\p{{Nd}}+(?:[.,]\p{{Nd}}+)?{WORD_ENDS}"))


def named_tokens(c: Column) -> Column:
    """Tokens with a capital after their first character, in capitals only, or with a digit; lower-cased."""
    found = _all(c, rf"{EDGE}[A-Za-z][A-Za-z0-9+/#&.'-]{{2,}}{EDGE}")
    named = F.filter(found, lambda t: F.substr(t, F.lit(2)).rlike("[A-Z]") | t.rlike("[0-9]") | ((t == F.upper(t)) & t.rlike("[A-Z]")))
    return F.array_distinct(F.transform(named, F.lower))


def anchors(c: Column, with_names: Column) -> Column:
    base = F.array_union(F.array_union(urls(c), years(c)), numbers(c))
    return F.when(with_names, F.array_union(base, named_tokens(c))).otherwise(base)


def missing_anchors(found: Column, output: Column) -> Column:
    """How many anchors are no substring of the compacted, lower-cased output."""
    return F.transform(F.array(F.lower(compact(output))), lambda folded: F.size(F.filter(found, lambda a: ~F.contains(folded, a))))[0]


def four_decimals(c: Column) -> Column:
    return F.replace(F.format_number(c, 4), F.lit(","), F.lit(""))


def two_decimals(c: Column) -> Column:
    return F.replace(F.format_number(c, 2), F.lit(","), F.lit(""))


def clean(c: Column) -> Column:
    """Without URLs, then Markdown links, then handles, then all that is no word character or space."""
    for pattern in (r"(?U)http[s]?://\S+", r"(?d)\[.*?\]\(.*?\)", rf"@[{W}]+", rf"(?U)[^{W}\s]"):
        c = F.regexp_replace(c, pattern, "")
    return strip(c)


def shortened(c: Column, limit: int, mark: str) -> Column:
    """The stripped text, cut after `limit` characters, stripped at its end and marked."""
    whole = strip(text_or_empty(c))
    return F.when(F.length(whole) > limit, F.concat(rstrip(F.left(whole, F.lit(limit))), F.lit(mark))).otherwise(whole)


def without_fence(c: Column) -> Column:
    """The inside of a text of three lines or more whose first and last are code fences."""
    whole = strip(text_or_empty(c))
    inside = F.regexp_extract(whole, r"(?s)^```[^\n]*\n(.*)\n[^\S\n]*```[^\S\n]*$", 1)
    fenced = F.startswith(whole, F.lit("```")) & (F.size(F.split(whole, "\n")) >= 3) & whole.rlike(r"(?s)\n[^\S\n]*```[^\S\n]*$")
    return F.when(fenced, strip(inside)).otherwise(whole)


def fragment_problem(source: Column, output: Column) -> Column:
    """Why a translated fragment looks wrong, or null."""
    out, low = strip(text_or_empty(output)), F.lower(strip(text_or_empty(output)))
    n, m = F.length(strip(text_or_empty(source))), F.length(out)
    shaped = F.startswith(low, F.lit("row_id,")) | F.startswith(low, F.lit("{")) | F.startswith(low, F.lit("["))
    short = (n >= 220) & (m < F.greatest(F.lit(50), (n * F.lit(0.22)).cast("int")))
    return (
        F.when(out == "", "empty_fragment").when(F.contains(out, F.lit("```")), "markdown_fence_detected").when(shaped, "structured_output_detected").when(short, F.concat(F.lit("fragment_too_short:"), m.cast("string"), F.lit("/"), n.cast("string")))
    )


def tokens(c: Column) -> Column:
    """White space tokens of the cleaned text, with `cannot` in two."""
    split = F.filter(F.split(clean(text_or_empty(c)), r"(?U)\s+"), lambda t: t != "")
    return F.flatten(F.transform(split, lambda t: F.when(F.lower(t) == "cannot", F.array(F.left(t, F.lit(3)), F.substr(t, F.lit(4)))).otherwise(F.array(t))))
