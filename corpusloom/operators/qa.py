"""Translation quality: metrics, suspicion score, the suspicious report and its high-confidence part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import QaThresholds
from corpusloom.functions import text as T

REPORT = (
    "row_id label source_chars translated_chars source_words translated_words source_sentences translated_sentences char_ratio word_ratio"
    " sentence_ratio english_token_ratio anchor_count missing_anchor_count anchor_miss_ratio spacing_quality_low suspicion_score reasons"
    " source_text current_translation new_translation action"
).split()
SURE_REPORT = [c for c in REPORT if c not in ("english_token_ratio", "spacing_quality_low")]
SURE_REPORT[SURE_REPORT.index("reasons") + 1 : SURE_REPORT.index("reasons") + 1] = ["high_confidence_reason", "source_report_action"]
#: One of these must stand in the reasons of a high-confidence row.
SURE_MARKS = ("char_ratio_too_low", "word_ratio_too_low", "sentence_collapse")


def settled(df: DataFrame) -> DataFrame:
    """df behind a generator of one row each. Filters on its columns then read them; without it they would be pushed below
    and evaluate the columns' whole expressions, which nest, again for every use."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def with_metrics(pairs: DataFrame, limits: QaThresholds = QaThresholds()) -> DataFrame:
    """pairs (row_id, label, source_text, current_translation) that are not blank, with lengths, ratios and anchors.

    Each step is a projection of its own, so texts are stripped and searched once.
    """
    src, out = F.col("_s"), F.col("_t")
    df = pairs.where(~T.is_blank(F.col("source_text")) & ~T.is_blank(F.col("current_translation")))
    df = df.withColumns({"_s": T.strip(F.col("source_text")), "_t": T.strip(F.col("current_translation"))})
    df = df.withColumns(
        {
            "source_chars": F.length(src), "translated_chars": F.length(out), "source_words": T.count_words(src), "translated_words": T.count_words(out),
            "source_sentences": T.count_sentences(src), "translated_sentences": T.count_sentences(out), "_english": T.english_ratio(out), "_low": T.spacing_is_low(src),
        }
    )
    df = df.withColumns({"_long": F.col("source_chars") >= limits.long_text, "_cr": _ratio("translated_chars", "source_chars"), "_wr": _ratio("translated_words", "source_words"), "_sr": _ratio("translated_sentences", "source_sentences")})
    df = df.withColumn("_anchors", T.anchors(src, ~F.col("_low") & ~F.col("_long")))
    df = df.withColumns({"anchor_count": F.size("_anchors"), "missing_anchor_count": T.missing_anchors(F.col("_anchors"), out)})
    return settled(df.withColumn("_miss", _ratio("missing_anchor_count", "anchor_count")))


def suspicious(pairs: DataFrame, limits: QaThresholds = QaThresholds()) -> DataFrame:
    """The suspicious report: rows for which at least one rule fires, with score and reasons in rule order."""
    q = limits
    df = with_metrics(pairs, q)
    sc, tc, cr, wr, sr, er, miss = (F.col(c) for c in ("source_chars", "translated_chars", "_cr", "_wr", "_sr", "_english", "_miss"))
    ss, ts, long, low = F.col("source_sentences"), F.col("translated_sentences"), F.col("_long"), F.col("_low")
    off = F.abs(tc - sc) > F.greatest(F.lit(q.long_abs_tolerance), (sc * F.lit(q.long_rel_tolerance)).cast("int"))
    enough, many = sc >= q.min_source_chars, ~low & (F.col("anchor_count") >= 3)
    lost = F.concat(F.col("missing_anchor_count").cast("string"), F.lit("/"), F.col("anchor_count").cast("string"))
    points = lambda c, by: (c * F.lit(by)).cast("int")
    rule = lambda when, score, name, tail=None: (when, score, F.lit(name) if tail is None else F.concat(F.lit(f"{name}:"), tail))
    groups = [
        [
            rule(enough & long & (cr < q.long_min_char_ratio) & off, points(F.lit(q.long_min_char_ratio) - cr, 140), "long_char_ratio_too_low", T.two_decimals(cr)),
            rule(enough & long & (cr > q.long_max_char_ratio) & off, points(cr - F.lit(q.long_max_char_ratio), 100), "long_char_ratio_too_high", T.two_decimals(cr)),
        ],
        [
            rule(enough & ~long & (cr < q.min_char_ratio), points(F.lit(q.min_char_ratio) - cr, 100), "char_ratio_too_low", T.two_decimals(cr)),
            rule(enough & ~long & (cr > q.max_char_ratio), points(cr - F.lit(q.max_char_ratio), 100), "char_ratio_too_high", T.two_decimals(cr)),
        ],
        [
            rule(enough & ~low & ~long & (wr < q.min_word_ratio), points(F.lit(q.min_word_ratio) - wr, 120), "word_ratio_too_low", T.two_decimals(wr)),
            rule(enough & ~low & ~long & (wr > q.max_word_ratio), points(wr - F.lit(q.max_word_ratio), 120), "word_ratio_too_high", T.two_decimals(wr)),
        ],
        [rule((F.col("source_words") >= 12) & (F.col("translated_words") <= 3), F.lit(30), "translation_too_short_for_long_source")],
        [
            rule(long & (ss >= 4) & ((ts == 1) | (sr < 0.25)), F.lit(25), "long_text_sentence_collapse"),
            rule(long & (ss >= 4) & (sr > 4.0) & off, F.lit(15), "long_text_sentence_expansion"),
        ],
        [rule(~long & (ss >= 3) & (ts == 1), F.lit(10), "sentence_collapse"), rule(~long & (ss > 0) & (ts >= 3 * ss), F.lit(10), "sentence_expansion")],
        [rule(er > q.max_english_ratio, points(er - F.lit(q.max_english_ratio), 100), "english_residue", T.two_decimals(er))],
        [
            rule(many & ~long & (miss > q.max_anchor_miss), points(miss, 80), "anchor_loss", lost),
            rule(many & long & (F.col("missing_anchor_count") >= 4) & (miss > 0.65), points(miss, 50), "long_text_anchor_loss", lost),
        ],
    ]
    fired = []
    for group in groups:
        hit = None
        for when, score, name in group:
            value = F.struct(score.alias("score"), name.alias("reason"))
            hit = F.when(when, value) if hit is None else hit.when(when, value)
        fired.append(hit)
    df = settled(df.withColumn("_fired", F.array_compact(F.array(*fired)))).where(F.size("_fired") > 0)
    strings = {"char_ratio": cr, "word_ratio": wr, "sentence_ratio": sr, "english_token_ratio": er, "anchor_miss_ratio": miss}
    df = df.withColumns({k: T.four_decimals(c) for k, c in strings.items()} | {"suspicion_score": F.aggregate("_fired", F.lit(0), lambda a, x: a + x["score"]), "reasons": F.array_join(F.transform("_fired", lambda x: x["reason"]), ";")})
    df = df.withColumns({"spacing_quality_low": F.when(low, "True").otherwise("False"), "new_translation": F.lit(""), "action": F.lit("pending"), "source_text": F.col("_s"), "current_translation": F.col("_t")})
    return settled(df.select(*REPORT))


def ranked(report: DataFrame, most: int = 0) -> DataFrame:
    """Worst first; the first `most` rows if that is not 0."""
    out = report.orderBy(F.desc("suspicion_score"), F.asc("row_id"))
    return out.limit(most) if most else out


def sure_reason(q: QaThresholds = QaThresholds()) -> Column:
    """High-confidence class of a stored report row, or null. Ratios are the stored strings of four decimals."""
    number = lambda c, kind: F.when(T.is_blank(F.col(c)), F.lit(0).cast(kind)).otherwise(F.trim(F.col(c).cast("string")).try_cast(kind))
    whole = {c: number(c, "bigint") for c in ("source_chars", "translated_chars", "source_words", "source_sentences", "translated_sentences", "anchor_count", "missing_anchor_count")}
    part = {c: number(c, "double") for c in ("char_ratio", "word_ratio", "sentence_ratio", "anchor_miss_ratio")}
    usable = F.lower(F.trim(F.coalesce("spacing_quality_low", F.lit("")))) != "true"
    for c in (*whole.values(), *part.values()):
        usable = usable & c.isNotNull()
    marked = F.lit(False)
    for mark in SURE_MARKS:
        marked = marked | F.contains(F.coalesce("reasons", F.lit("")), F.lit(mark))
    usable = usable & (whole["source_chars"] >= q.sure_min_chars) & (whole["source_words"] >= q.sure_min_words) & marked
    shorter = (part["char_ratio"] <= q.sure_char_ratio) & (part["word_ratio"] <= q.sure_word_ratio)
    third = F.floor(whole["source_sentences"] / 3)
    collapsed = (whole["source_sentences"] >= 4) & (part["sentence_ratio"] <= q.sure_sentence_ratio) & (whole["translated_sentences"] <= F.greatest(F.lit(2), third))
    lost = (whole["anchor_count"] >= 4) & (part["anchor_miss_ratio"] >= 0.85) & (whole["missing_anchor_count"] >= 4)
    tiny = whole["translated_chars"] <= F.greatest(F.lit(180), (whole["source_chars"] * F.lit(0.40)).cast("int"))
    reason = (
        F.when(shorter & collapsed, "severe_shortening_and_sentence_collapse").when(shorter & lost, "severe_shortening_and_anchor_loss").when(shorter, "severe_shortening")
        .when(collapsed & lost, "sentence_collapse_and_anchor_loss").when(collapsed & tiny, "severe_sentence_collapse")
    )
    return F.when(usable, reason)


def sure_report(report: DataFrame, limits: QaThresholds = QaThresholds(), most: int = 0) -> DataFrame:
    """The high-confidence part of a suspicious report, reset to pending, most lost anchors first. The report is written first:
    classes read each column often, and a sort samples its input before it reads it."""
    from corpusloom.operators.reports import normal_action
    from corpusloom.storage import written

    df = settled(written(report, "report").withColumn("high_confidence_reason", sure_reason(limits))).where("high_confidence_reason IS NOT NULL")
    df = df.withColumns({"source_report_action": normal_action(F.col("action")), "action": F.lit("pending"), "new_translation": F.lit("")})
    order = (F.desc(F.coalesce(F.col("anchor_miss_ratio").try_cast("double"), F.lit(0.0))), F.asc(F.coalesce(F.col("char_ratio").try_cast("double"), F.lit(1.0))), F.asc(F.coalesce(F.col("row_id").cast("bigint"), F.lit(0))))
    out = df.select(*SURE_REPORT).orderBy(*order)
    return out.limit(most) if most else out
