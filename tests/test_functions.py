"""Scalar functions against golden vectors and plain Python twins."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import chunking, locales
from corpusloom.functions import text as T
from corpusloom.functions.stemming import stem


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{k} string" for k in range(len(values))))
    return df.select(f(*(F.col(c) for c in df.columns)).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.count_sentences, "Hi... there?! ok", 3), (T.count_words, "don't stop_1 é", 4), (T.english_ratio, "I don't saber the respuesta", 0.6), (T.english_ratio, "¿?", 0.0),
        (T.spacing_is_low, "aaaaaaaaaa bbbbbbbbbb", True), (T.spacing_is_low, " \t", False), (T.strip, "\t a \n ", "a"), (T.compact, " a \n\t b ", "a b"), (T.is_blank, None, True),
        (T.clean, "See [poll](https://r.com/x) @bob!! ok_1", "See poll  ok_1"), (T.clean, "[a](b) c@d e.f", "c ef"), (T.without_fence, "```json\n[1]\n```", "[1]"), (T.without_fence, "```a```", "```a```"),
        (lambda c: T.shortened(c, 500, "..."), "x" * 499 + " y", "x" * 499 + "..."), (lambda c: T.shortened(c, 800, " ..."), "x" * 800, "x" * 800), (lambda c: T.anchors(c, F.lit(True)), "Meet at 10 on 2020 see www.X.org for iPhone", ["www.x.org", "2020", "10", "iphone"]),
        (lambda c: T.missing_anchors(F.array(F.lit("10"), F.lit("2020"), F.lit("q")), c), "1020200", 1), (T.named_tokens, "éAbc iPhone NASA a1b abc A+.x", ["iphone", "nasa", "a1b"]), (T.tokens, "I cannot, stop!", ["I", "can", "not", "stop"]),
        (locales.normal_locale, "EN-UK", "en-GB"), (locales.normal_locale, "ES_ar", "es-AR"), (locales.normal_locale, "a-b-c", None), (locales.normal_locale, "", None), (locales.normal_locale, "es", None), (locales.translated_column, "es-AR", "statement_es_ar"),
    ],
)
def test_golden(spark, f, value, want):
    assert one(spark, f, value) == want


@pytest.mark.parametrize(
    ("n", "output", "want"),
    [(300, " ", "empty_fragment"), (9, "a```", "markdown_fence_detected"), (9, "[hola", "structured_output_detected"), (9, "ROW_ID,x", "structured_output_detected"), (300, "a" * 65, "fragment_too_short:65/300"), (300, "a" * 66, None), (219, "a", None)],
)
def test_fragment_problem(spark, n, output, want):
    assert one(spark, T.fragment_problem, "s" * n, output) == want


def test_four_decimals(spark):
    rows = spark.range(1, 200).select((F.col("id") / 32).alias("x"), T.four_decimals(F.col("id") / 32).alias("s")).collect()
    assert all(r["s"] == f"{r['x']:.4f}" for r in rows)


def test_chunking_golden():
    assert chunking.sentence_fragments('Dr. Smith paid 3.50. Then he left! "Really?" Yes') == ["Dr. Smith paid 3.50.", "Then he left!", '"Really?"', "Yes"]
    assert chunking.sentence_fragments("I like cats, dogs, etc. They are nice.") == ["I like cats, dogs, etc. They are nice."]
    assert chunking.chunks_of("aa bb cc. dd ee ff.", 10) == ["aa bb cc.", "dd ee ff."] and chunking.chunks_of("aa bb cc.  dd ee ff.", 500) == ["aa bb cc. dd ee ff."]
    assert chunking.chunks_of("a" * 30, 10) == ["a" * 30] and chunking.chunks_of(" \n", 9) == [] and chunking.sentence_fragments(None) == []
    assert chunking.long_fragment_pieces("one two; three four", 10) == ["one two;", "three four"] and chunking.long_fragment_pieces("a, but b, and c", 30) == ["a,", "but b,", "and c"]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abc .,;:!?\n\"')andU.S3é"), max_size=300), st.integers(5, 60))
def test_chunks_keep_the_text(text, limit):
    chunks = chunking.chunks_of(text, limit)
    assert " ".join(chunks).split() == text.split()
    assert all(len(c) <= limit or " " not in c for c in chunks)


@pytest.mark.parametrize(
    ("word", "want"),
    [x.split(":") for x in "caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop falling:fall hissing:hiss fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration vietnamization:vietnam predication:predic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope formaliti:formal triplicate:triplic formative:form formalize:formal electriciti:electr electrical:electr goodness:good revival:reviv allowance:allow inference:infer airliner:airlin adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust dependent:depend adoption:adopt homologou:homolog communism:commun activate:activ effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll happiness:happi".split()],
)
def test_porter(word, want):
    assert stem(word) == want


def test_blanks_around_line_breaks():
    assert chunking.sentence_fragments("a \n b.  C\n\n d\t\n\te") == ["a b.", "C", "d e"]


def test_strip_is_linear(spark):
    import time

    started = time.monotonic()
    assert one(spark, lambda c: F.length(T.strip(c)), " a" + " " * 200_000 + "b\u00a0\n") == 200_002
    assert one(spark, lambda c: T.is_blank(c), " \t\u00a0" * 9) and one(spark, T.count_sentences, " . .!? a\u00a0b. \u00a0") == 1
    assert time.monotonic() - started < 20


def test_locales_are_checked(spark):
    assert one(spark, locales.checked_locale, "\ten_gb\n") == "en-GB" and locales.described(" ES_ar") == ("es-AR", "Spanish as used in Argentina (es-AR)")
    for bad in ("", "es", "a-b-c"):
        with pytest.raises(Exception, match="no locale"):
            one(spark, locales.checked_locale, bad)
        with pytest.raises(ValueError):
            locales.described(bad)


def test_names():
    assert locales.output_name("es-ES") == "Combined Data es-ES.csv"
    assert locales.output_name("es-AR", "data/Combined Data.csv") == "data/Combined Data es-AR.csv"
