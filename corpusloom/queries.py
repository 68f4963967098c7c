"""Queries of the audit and analysis operators over the driver's tables, with the SQL that they must equal.

A translation is made from each document by a rule on its id, so that every audit rule has rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import TranslateConfig
from corpusloom.functions import chunking, locales
from corpusloom.functions import text as T
from corpusloom.functions.stemming import stems
from corpusloom.operators import eda, ml, qa, reports, translate
from corpusloom.plans import passes
from corpusloom.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LANGS = ("de", "en", "es", "fr", "it")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def made_translation(i: Column, t: Column) -> Column:
    n = F.length(t)
    cases = {
        0: t, 1: F.left(t, F.floor(n / 8).cast("int")), 2: F.concat_ws(" ", t, t, t, t, t), 3: F.lit(""), 4: F.regexp_replace(t, "[.!?]", ""), 5: F.regexp_replace(t, "[0-9A-Z]", ""),
        6: F.array_join(F.slice(F.split(F.trim(t), r"\s+"), 1, 2), " "), 7: F.repeat(F.lit("the and is not my "), F.greatest(F.lit(1), F.floor(n / 18).cast("int"))),
    }
    out = F.replace(t, F.lit(" "), F.lit(". "))
    for k, value in reversed(cases.items()):
        out = F.when(i % 9 == k, value).otherwise(out)
    return out


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), F.col("text").alias("source_text"), made_translation(F.col("doc_id"), F.col("text")).alias("current_translation"))


PAIRS = r"""pairs AS (SELECT doc_id AS row_id, lang AS label, text AS source_text, CASE doc_id % 9 WHEN 0 THEN text WHEN 1 THEN left(text, length(text) // 8)
 WHEN 2 THEN concat_ws(' ', text, text, text, text, text) WHEN 3 THEN '' WHEN 4 THEN regexp_replace(text, '[.!?]', '', 'g') WHEN 5 THEN regexp_replace(text, '[0-9A-Z]', '', 'g')
 WHEN 6 THEN array_to_string(list_slice(string_split_regex(trim(text), '\s+'), 1, 2), ' ') WHEN 7 THEN repeat('the and is not my ', greatest(1, length(text) // 18))
 ELSE replace(text, ' ', '. ') END AS current_translation FROM documents)"""


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def words_sql(c: str) -> str:
    return rf"len(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+'))"


def sentences_sql(c: str) -> str:
    return rf"len(list_filter(string_split_regex({c}, '[.!?]+'), lambda x: regexp_matches(x, '\S')))"


_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in T.ENGLISH_WORDS)


def english_sql(c: str) -> str:
    tokens = f"regexp_extract_all({c}, '[A-Za-z'']+')"
    return f"CASE WHEN len({tokens}) > 0 THEN len(list_filter({tokens}, lambda x: list_contains([{_WORDS}], lower(x))))::DOUBLE / len({tokens}) ELSE 0 END"


def compact_sql(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def low_sql(c: str) -> str:
    one = compact_sql(c)
    alpha, tokens = rf"length(regexp_replace({one}, '[^\p{{L}}]', '', 'g'))", f"len(string_split({one}, ' '))"
    return f"({one} <> '' AND ({alpha}::DOUBLE / {tokens} >= 9.5 OR ({tokens} >= 8 AND ({tokens} - 1)::DOUBLE / greatest({alpha}, 1) <= 0.085)))"


def _ascii(c: str) -> str:
    """Other letters as underscores: word characters that are in no token."""
    return rf"regexp_replace({c}, '[^\x00-\x7F]', '_', 'g')"


def urls_sql(c: str) -> str:
    return rf"list_transform(regexp_extract_all({c}, 'https?://\S+|www\.\S+'), lambda x: lower(x))"


def years_sql(c: str) -> str:
    return rf"regexp_extract_all({_ascii(c)}, '\b(?:19|20)\d{{2}}\b')"


def numbers_sql(c: str) -> str:
    return rf"regexp_extract_all({_ascii(c)}, '\b\d+(?:[.,]\d+)?\b')"


def named_sql(c: str) -> str:
    found = rf"regexp_extract_all({_ascii(c)}, '\b[A-Za-z][A-Za-z0-9+/#&.''-]{{2,}}\b')"
    return f"list_transform(list_filter({found}, lambda x: regexp_matches(substr(x, 2), '[A-Z]') OR regexp_matches(x, '[0-9]') OR (x = upper(x) AND regexp_matches(x, '[A-Z]'))), lambda x: lower(x))"


METRICS = f"""{PAIRS}, stripped AS (SELECT row_id, label, {strip_sql('source_text')} AS s, {strip_sql('current_translation')} AS t FROM pairs),
counted AS (SELECT *, length(s) AS sc, length(t) AS tc, {words_sql('s')} AS sw, {words_sql('t')} AS tw, {sentences_sql('s')} AS ss, {sentences_sql('t')} AS ts, {english_sql('t')} AS er, {low_sql('s')} AS low,
 length(s) >= 5000 AS long FROM stripped WHERE s <> '' AND t <> ''),
rated AS (SELECT *, CASE WHEN sc > 0 THEN tc::DOUBLE / sc ELSE 0 END AS cr, CASE WHEN sw > 0 THEN tw::DOUBLE / sw ELSE 0 END AS wr, CASE WHEN ss > 0 THEN ts::DOUBLE / ss ELSE 0 END AS sr,
 list_distinct(list_concat({urls_sql('s')}, {years_sql('s')}, {numbers_sql('s')}, CASE WHEN NOT low AND NOT long THEN {named_sql('s')} ELSE [] END)) AS a, lower({compact_sql('t')}) AS f FROM counted),
missed AS (SELECT *, len(a) AS an, len(list_filter(a, lambda x: NOT contains(f, x))) AS am, abs(tc - sc) > greatest(1200, trunc(sc * 0.18::DOUBLE)) AS off FROM rated),
metrics AS (SELECT *, CASE WHEN an > 0 THEN am::DOUBLE / an ELSE 0 END AS miss FROM missed)"""


def _rule(*cases: tuple[str, str, str]) -> str:
    whens = " ".join(f"WHEN {when} THEN {{'score': trunc({score})::BIGINT, 'reason': {reason}}}" for when, score, reason in cases)
    return f"CASE {whens} END"


def _f2(name: str, value: str) -> str:
    return f"'{name}:' || printf('%.2f', {value})"


_D = "::DOUBLE"
RULES = ", ".join(
    _rule(*cases)
    for cases in (
        [(f"sc >= 40 AND long AND cr < 0.18{_D} AND off", f"(0.18{_D} - cr) * 140", _f2("long_char_ratio_too_low", "cr")), (f"sc >= 40 AND long AND cr > 3.5{_D} AND off", f"(cr - 3.5{_D}) * 100", _f2("long_char_ratio_too_high", "cr"))],
        [(f"sc >= 40 AND NOT long AND cr < 0.45{_D}", f"(0.45{_D} - cr) * 100", _f2("char_ratio_too_low", "cr")), (f"sc >= 40 AND NOT long AND cr > 2.35{_D}", f"(cr - 2.35{_D}) * 100", _f2("char_ratio_too_high", "cr"))],
        [(f"sc >= 40 AND NOT low AND NOT long AND wr < 0.45{_D}", f"(0.45{_D} - wr) * 120", _f2("word_ratio_too_low", "wr")), (f"sc >= 40 AND NOT low AND NOT long AND wr > 2.35{_D}", f"(wr - 2.35{_D}) * 120", _f2("word_ratio_too_high", "wr"))],
        [("sw >= 12 AND tw <= 3", "30", "'translation_too_short_for_long_source'")],
        [("long AND ss >= 4 AND (ts = 1 OR sr < 0.25)", "25", "'long_text_sentence_collapse'"), ("long AND ss >= 4 AND sr > 4.0 AND off", "15", "'long_text_sentence_expansion'")],
        [("NOT long AND ss >= 3 AND ts = 1", "10", "'sentence_collapse'"), ("NOT long AND ss > 0 AND ts >= 3 * ss", "10", "'sentence_expansion'")],
        [(f"er > 0.35{_D}", f"(er - 0.35{_D}) * 100", _f2("english_residue", "er"))],
        [("NOT low AND an >= 3 AND NOT long AND miss > 0.45", "miss * 80", "'anchor_loss:' || am || '/' || an"), ("NOT low AND an >= 3 AND long AND am >= 4 AND miss > 0.65", "miss * 50", "'long_text_anchor_loss:' || am || '/' || an")],
    )
)
REPORT = f"""{METRICS}, fired AS (SELECT *, list_filter([{RULES}], lambda x: x IS NOT NULL) AS hits FROM metrics),
report AS (SELECT row_id, label, sc AS source_chars, tc AS translated_chars, sw AS source_words, tw AS translated_words, ss AS source_sentences, ts AS translated_sentences,
 printf('%.4f', cr) AS char_ratio, printf('%.4f', wr) AS word_ratio, printf('%.4f', sr) AS sentence_ratio, printf('%.4f', er) AS english_token_ratio, an AS anchor_count, am AS missing_anchor_count,
 printf('%.4f', miss) AS anchor_miss_ratio, CASE WHEN low THEN 'True' ELSE 'False' END AS spacing_quality_low, list_sum(list_transform(hits, lambda x: x.score))::BIGINT AS suspicion_score,
 array_to_string(list_transform(hits, lambda x: x.reason), ';') AS reasons, s AS source_text, t AS current_translation, '' AS new_translation, 'pending' AS action FROM fired WHERE len(hits) > 0)"""
SURE = f"""{REPORT}, sure AS (SELECT *, char_ratio::DOUBLE <= 0.28::DOUBLE AND word_ratio::DOUBLE <= 0.3::DOUBLE AS sh, source_sentences >= 4 AND sentence_ratio::DOUBLE <= 0.34::DOUBLE AND translated_sentences <= greatest(2, source_sentences // 3) AS co,
 anchor_count >= 4 AND anchor_miss_ratio::DOUBLE >= 0.85::DOUBLE AND missing_anchor_count >= 4 AS lo FROM report WHERE spacing_quality_low <> 'True' AND source_chars >= 120 AND source_words >= 25
 AND (contains(reasons, 'char_ratio_too_low') OR contains(reasons, 'word_ratio_too_low') OR contains(reasons, 'sentence_collapse'))),
named AS (SELECT *, CASE WHEN sh AND co THEN 'severe_shortening_and_sentence_collapse' WHEN sh AND lo THEN 'severe_shortening_and_anchor_loss' WHEN sh THEN 'severe_shortening'
 WHEN co AND lo THEN 'sentence_collapse_and_anchor_loss' WHEN co AND translated_chars <= greatest(180, trunc(source_chars * 0.4::DOUBLE)) THEN 'severe_sentence_collapse' END AS high_confidence_reason FROM sure)"""
_SLIM = [c for c in qa.REPORT if c not in ("source_text", "current_translation")]
_SURE_SLIM = [c for c in qa.SURE_REPORT if c not in ("source_text", "current_translation")]


@query(f"WITH {METRICS} SELECT row_id, sc AS source_chars, tc AS translated_chars, sw AS source_words, tw AS translated_words, ss AS source_sentences, ts AS translated_sentences, printf('%.4f', er) AS english_ratio, low AS spacing_low FROM metrics")
def text_metrics(spark, sf_dir):
    df = qa.with_metrics(pairs(spark, sf_dir))
    return df.select("row_id", "source_chars", "translated_chars", "source_words", "translated_words", "source_sentences", "translated_sentences", T.four_decimals(F.col("_english")).alias("english_ratio"), F.col("_low").alias("spacing_low"))


@query(f"SELECT doc_id, {english_sql('text')} AS ratio FROM documents")
def english_token_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.english_ratio(F.col("text")).alias("ratio"))


@query(f"SELECT doc_id, {low_sql('text')} AS low, {low_sql(compact_sql('text').replace(chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g', chr(39) * 2 + ', ' + chr(39) + 'g'))} AS low_joined FROM documents")
def spacing_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.spacing_is_low(F.col("text")).alias("low"), T.spacing_is_low(F.regexp_replace("text", r"\s+", "")).alias("low_joined"))


@query(f"WITH {REPORT} SELECT {', '.join(_SLIM)}, md5(source_text) AS s, md5(current_translation) AS t FROM report")
def suspicious_report(spark, sf_dir):
    return qa.suspicious(pairs(spark, sf_dir)).select(*_SLIM, F.md5("source_text").alias("s"), F.md5("current_translation").alias("t"))


@query(f"WITH {REPORT} SELECT row_id, suspicion_score, reasons FROM report ORDER BY suspicion_score DESC, row_id LIMIT 50")
def suspicious_top_k(spark, sf_dir):
    return qa.ranked(qa.suspicious(pairs(spark, sf_dir)), 50).select("row_id", "suspicion_score", "reasons")


@query(f"WITH {SURE} SELECT {', '.join(c if c != 'source_report_action' else chr(39) + 'pending' + chr(39) + ' AS source_report_action' for c in _SURE_SLIM)} FROM named WHERE high_confidence_reason IS NOT NULL")
def high_confidence_report(spark, sf_dir):
    return qa.sure_report(qa.suspicious(pairs(spark, sf_dir))).select(*_SURE_SLIM)


def _joined_list(c: str) -> str:
    return f"array_to_string(list_sort(list_distinct({c})), ' ')"


@query(f"SELECT page_id, {_joined_list(urls_sql(chr(39) + 'x ' + chr(39) + ' || url || ' + chr(39) + ' y www.A.b ' + chr(39)))} AS urls, {_joined_list(years_sql('html'))} AS years, {_joined_list(numbers_sql('html'))} AS numbers FROM pages")
def anchor_lists(spark, sf_dir):
    joined = lambda c: F.array_join(F.array_sort(c), " ")
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", joined(T.urls(F.concat(F.lit("x "), "url", F.lit(" y www.A.b ")))).alias("urls"), joined(T.years(F.col("html"))).alias("years"), joined(T.numbers(F.col("html"))).alias("numbers"))


@query(f"SELECT page_id, {_joined_list(named_sql('html'))} AS names FROM pages")
def anchor_named(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(T.named_tokens(F.col("html"))), " ").alias("names"))


@query(f"WITH {METRICS} SELECT row_id, an AS n, am AS missing, miss AS ratio FROM metrics")
def anchor_overlap(spark, sf_dir):
    return qa.with_metrics(pairs(spark, sf_dir)).select("row_id", F.col("anchor_count").alias("n"), F.col("missing_anchor_count").alias("missing"), F.col("_miss").alias("ratio"))


_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, 'http[s]?://\S+', '', 'g'), '\[[^\n]*?\]\([^\n]*?\)', '', 'g'), '@[\p{L}\p{N}_]+', '', 'g'), '[^\p{L}\p{N}_\s]', '', 'g')"


@query(f"SELECT page_id, md5({strip_sql(_CLEAN.replace('{c}', chr(39) + 'see [x](y) @me ' + chr(39) + ' || url || html'))}) AS cleaned FROM pages")
def remove_patterns(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.clean(F.concat(F.lit("see [x](y) @me "), "url", "html"))).alias("cleaned"))


def _short_sql(n: int, mark: str) -> str:
    whole = strip_sql("text")
    return rf"CASE WHEN length({whole}) > {n} THEN regexp_replace(left({whole}, {n}), '\s+$', '') || '{mark}' ELSE {whole} END"


@query(f"SELECT doc_id, {_short_sql(500, '...')} AS short, {_short_sql(800, ' ...')} AS preview, md5({compact_sql('text')}) AS compacted FROM documents")
def truncate_preview(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.shortened(text, 500, "...").alias("short"), T.shortened(text, 800, " ...").alias("preview"), F.md5(T.compact(text)).alias("compacted"))


_OUT = strip_sql("output")
_FRAGMENT = f"""WITH {PAIRS}, f AS (SELECT row_id, source_text, CASE row_id % 5 WHEN 0 THEN ' [' || current_translation WHEN 1 THEN 'a ```' || current_translation WHEN 2 THEN 'ROW_ID,x' ELSE current_translation END AS output FROM pairs)
SELECT row_id, CASE WHEN {_OUT} = '' THEN 'empty_fragment' WHEN contains({_OUT}, '```') THEN 'markdown_fence_detected' WHEN starts_with(lower({_OUT}), 'row_id,') OR starts_with({_OUT}, '{{') OR starts_with({_OUT}, '[') THEN 'structured_output_detected'
 WHEN length({strip_sql('source_text')}) >= 220 AND length({_OUT}) < greatest(50, trunc(length({strip_sql('source_text')}) * 0.22::DOUBLE)) THEN 'fragment_too_short:' || length({_OUT}) || '/' || length({strip_sql('source_text')}) END AS problem FROM f"""


@query(_FRAGMENT)
def fragment_checks(spark, sf_dir):
    i, t = F.col("row_id") % 5, F.col("current_translation")
    output = F.when(i == 0, F.concat(F.lit(" ["), t)).when(i == 1, F.concat(F.lit("a ```"), t)).when(i == 2, "ROW_ID,x").otherwise(t)
    return pairs(spark, sf_dir).select("row_id", T.fragment_problem(F.col("source_text"), output).alias("problem"))


def output_table(spark, sf_dir):
    return pairs(spark, sf_dir).select("row_id", "label", "source_text", F.col("current_translation").alias("cell"))


@query(f"WITH {PAIRS} SELECT d.doc_id AS row_id, md5(coalesce(p.current_translation, '')) AS cell FROM documents d LEFT JOIN (SELECT * FROM pairs WHERE row_id % 7 <> 0) p ON p.row_id = d.doc_id")
def align_by_id(spark, sf_dir):
    source = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"))
    return reports.aligned(source, output_table(spark, sf_dir).where("row_id % 7 <> 0"), "cell", check=False).select("row_id", F.md5("cell").alias("cell"))


@query("SELECT kind, n FROM (SELECT 'duplicate' AS kind, (SELECT count(*) FROM documents WHERE doc_id % 10 = 0 AND doc_id % 7 <> 0) AS n UNION ALL SELECT 'missing', (SELECT count(*) FROM documents WHERE doc_id % 7 = 0)"
       " UNION ALL SELECT 'row_count', abs((SELECT count(*) FROM documents WHERE doc_id % 7 = 0) - (SELECT count(*) FROM documents WHERE doc_id % 10 = 0 AND doc_id % 7 <> 0)))")  # fmt: skip
def align_violations(spark, sf_dir):
    source = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"))
    output = source.where("row_id % 7 <> 0")
    return reports.alignment_problems(source, output.union(output.where("row_id % 10 = 0")))


@query("SELECT a.doc_id AS position, b.text AS cell FROM documents a LEFT JOIN (SELECT item_id, text FROM benchmark) b ON a.doc_id = b.item_id WHERE b.text IS NOT NULL UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)")
def positional_align(spark, sf_dir):
    source = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("position"))
    return reports.aligned_by_position(source, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("position"), F.col("text").alias("cell")), "cell")


@query(f"WITH {PAIRS} SELECT row_id, label FROM pairs WHERE row_id >= 100 AND {strip_sql('current_translation')} = ''")
def pending_rows(spark, sf_dir):
    return reports.pending(output_table(spark, sf_dir), "cell", 100).select("row_id", "label")


@query(f"WITH {PAIRS}, n AS (SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 8 + 1 AS batch_no FROM pairs WHERE {strip_sql('current_translation')} = '') SELECT batch_no, min(row_id) AS first_row, max(row_id) AS last_row, count(*) AS n FROM n GROUP BY batch_no")
def pending_batches(spark, sf_dir):
    return reports.batch_bounds(reports.batched(reports.pending(output_table(spark, sf_dir), "cell").select("row_id"), 8))


def queue_table(spark, sf_dir):
    """All documents as a queue, and all benchmark items as rows whose ids are no numbers."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    old = docs.select(F.col("doc_id").cast("string").alias("row_id"), F.col("lang").alias("label"), F.lit("old").alias("reason"), F.length("text").alias("text_length"))
    return old.unionAll(items.select(F.concat(F.lit("x"), F.col("item_id")), F.lit("item"), F.lit("old"), F.length("text")))


@query("WITH q AS (SELECT doc_id, lang AS label, length(text) AS l, 'old' AS reason, 0 AS age FROM documents UNION ALL SELECT doc_id, 'quality ' || quality, toxic, 'new', 1 FROM labels)"
       " SELECT doc_id AS row_id, label, reason, l AS text_length FROM q QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY age DESC) = 1")  # fmt: skip
def problem_queue_upsert(spark, sf_dir):
    new = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("row_id"), F.concat(F.lit("quality "), F.col("quality")).alias("label"), F.lit("new").alias("reason"), F.col("toxic").cast("int").alias("text_length"))
    return reports.queue_upsert(queue_table(spark, sf_dir), new).select("row_id", "label", "reason", "text_length")


@query("SELECT doc_id::VARCHAR AS row_id, lang AS label FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'x' || item_id, 'item' FROM benchmark")
def queue_resolve_anti(spark, sf_dir):
    resolved = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"))
    return reports.queue_without(queue_table(spark, sf_dir), resolved).select("row_id", "label")


@query(f"WITH {PAIRS} SELECT l.doc_id AS row_id, l.quality FROM labels l JOIN pairs p ON p.row_id = l.doc_id WHERE {strip_sql('p.current_translation')} = ''")
def queue_join_output(spark, sf_dir):
    queue = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), "quality")
    return reports.queue_with_output(queue, output_table(spark, sf_dir), "cell").select("row_id", "quality")


_SELECTED = f"""{PAIRS}, ids AS (SELECT item_id * 7 AS row_id FROM benchmark UNION ALL SELECT -1), picked AS (SELECT i.row_id, coalesce(p.label, '') AS label, coalesce(p.source_text, '') AS source_text,
 coalesce(CASE WHEN i.row_id % 5 <> 0 THEN p.current_translation END, '') AS current_translation, '' AS new_translation, CASE WHEN p.row_id IS NULL OR i.row_id % 5 = 0 THEN 'missing_row' WHEN {strip_sql('p.current_translation')} <> '' THEN 'success' ELSE 'pending' END AS action
 FROM ids i LEFT JOIN pairs p ON p.row_id = i.row_id)"""


def selected(spark, sf_dir):
    out = output_table(spark, sf_dir)
    ids = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 7).alias("row_id")).union(spark.range(-1, 0).toDF("row_id"))
    return reports.selected_report(ids, out.drop("cell"), out.where("row_id % 5 <> 0"), "cell")


@query(f"WITH {_SELECTED} SELECT * FROM picked")
def selected_rows_report(spark, sf_dir):
    return selected(spark, sf_dir)


@query(f"WITH {_SELECTED} SELECT row_id, label, CASE WHEN row_id % 2 = 0 THEN 'kept' ELSE '' END AS new_translation, CASE WHEN row_id % 2 = 0 THEN 'success' ELSE action END AS action, row_id % 2 = 0 AS reused FROM picked")
def selected_report_merge(spark, sf_dir):
    fresh = selected(spark, sf_dir)
    old = fresh.where("row_id % 2 = 0").select("row_id", F.lit("kept").alias("new_translation"), F.lit(" retranslated").alias("action"))
    return reports.merged_report(fresh, old).select("row_id", "label", "new_translation", "action", "reused")


_ACTIONS = "['', ' flagged ', 'retranslated', 'failed:x', 'rejected_blank', 'empty_retry', 'success', 'missing_row']"
_ACTION = f"(SELECT doc_id, {_ACTIONS}[doc_id % 8 + 1] AS a FROM documents)"
_NORMAL = "CASE WHEN trim(a) IN ('', 'flagged') THEN 'pending' WHEN trim(a) = 'retranslated' THEN 'success' ELSE trim(a) END"


def with_actions(spark, sf_dir):
    words = F.array(*map(F.lit, ["", " flagged ", "retranslated", "failed:x", "rejected_blank", "empty_retry", "success", "missing_row"]))
    return table(spark, sf_dir, "documents").select("doc_id", F.element_at(words, (F.col("doc_id") % 8 + 1).cast("int")).alias("action"))


@query(f"SELECT {_NORMAL} AS action, count(*) AS n FROM {_ACTION} GROUP BY 1")
def report_action_summary(spark, sf_dir):
    return reports.action_summary(with_actions(spark, sf_dir))


_DONE = "n IN ('success', 'rejected_blank', 'missing_row')"


@query(f"SELECT doc_id, n AS action, {_DONE} OR n = 'empty_retry' OR starts_with(n, 'failed:') AS re_done, {_DONE} OR starts_with(n, 'failed:') AS sel_done, {_DONE} AS high_done FROM (SELECT doc_id, {_NORMAL} AS n FROM {_ACTION})")
def action_normalize(spark, sf_dir):
    a = F.col("action")
    return with_actions(spark, sf_dir).select("doc_id", reports.normal_action(a).alias("action"), *(reports.is_done(a, m).alias(k) for k, m in (("re_done", "reevaluate"), ("sel_done", "selected"), ("high_done", "high-confidence"))))


@query(f"WITH {PAIRS} SELECT row_id, md5(CASE WHEN row_id IN (SELECT doc_id FROM labels) THEN 'new ' || row_id ELSE current_translation END) AS cell FROM pairs")
def writeback_merge(spark, sf_dir):
    results = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), F.concat(F.lit("new "), F.col("doc_id").cast("string")).alias("new_text"))
    return reports.written_back(output_table(spark, sf_dir), results, "cell").select("row_id", F.md5("cell").alias("cell"))


@query(f"WITH {PAIRS}, b AS (SELECT row_id, current_translation AS c, row_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS hit FROM pairs) SELECT row_id, hit AND {strip_sql('c')} <> '' AS was_blanked, md5(CASE WHEN hit AND {strip_sql('c')} <> '' THEN '' ELSE c END) AS cell FROM b")
def blank_flagged(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("row_id"))
    return reports.blanked(output_table(spark, sf_dir), ids, "cell").select("row_id", "was_blanked", F.md5("cell").alias("cell"))


@query(f"WITH {PAIRS} SELECT row_id, md5(CASE WHEN {strip_sql('current_translation')} <> '' THEN current_translation ELSE label END) AS cell FROM pairs")
def rename_merge_column(spark, sf_dir):
    return reports.renamed_column(output_table(spark, sf_dir), "label", "cell").select("row_id", F.md5("cell").alias("cell"))


_RESPONSE = """(SELECT doc_id, [doc_id, doc_id + 1] AS expected, CASE doc_id % 6 WHEN 0 THEN [doc_id, doc_id + 1] WHEN 1 THEN [doc_id] WHEN 2 THEN [doc_id, doc_id] WHEN 3 THEN [doc_id, doc_id + 2] WHEN 4 THEN [doc_id, NULL] ELSE [doc_id, doc_id + 1] END AS ids,
 CASE doc_id % 6 WHEN 1 THEN ['a'] WHEN 5 THEN ['a', ' '] ELSE ['a', 'b'] END AS texts FROM documents)"""


@query(f"SELECT doc_id, CASE WHEN len(list_filter(ids, lambda x: x IS NULL)) > 0 THEN 'bad_id' WHEN len(list_filter(texts, lambda x: trim(x) = '')) > 0 THEN 'blank_text' WHEN len(list_filter(ids, lambda x: NOT list_contains(expected, x))) > 0 THEN 'unexpected_id'"
       f" WHEN len(list_distinct(ids)) < len(ids) THEN 'duplicate_id' WHEN len(list_filter(expected, lambda x: NOT list_contains(ids, x))) > 0 THEN 'omitted_id' END AS problem FROM {_RESPONSE}")  # fmt: skip
def validate_response_bijection(spark, sf_dir):
    i, case = F.col("doc_id"), F.col("doc_id") % 6
    ids = F.when(case == 1, F.array(i)).when(case == 2, F.array(i, i)).when(case == 3, F.array(i, i + 2)).when(case == 4, F.array(i, F.lit(None).cast("long"))).otherwise(F.array(i, i + 1))
    texts = F.when(case == 1, F.array(F.lit("a"))).when(case == 5, F.array(F.lit("a"), F.lit(" "))).otherwise(F.array(F.lit("a"), F.lit("b")))
    made = table(spark, sf_dir, "documents").select("doc_id", F.array(i, i + 1).alias("expected"), ids.alias("ids"), texts.alias("texts"))
    return made.select("doc_id", reports.response_problem(F.col("expected"), F.col("ids"), F.col("texts")).alias("problem"))


@query("WITH t AS (SELECT page_id, regexp_extract_all(url, '[0-9]+') AS a FROM pages), u AS (SELECT page_id, unnest(a)::BIGINT AS v, generate_subscripts(a, 1) AS k FROM t) SELECT page_id, string_agg(v, ' ' ORDER BY k) AS ids FROM (SELECT page_id, v, min(k) AS k FROM u GROUP BY page_id, v) GROUP BY page_id")
def parse_row_ids(spark, sf_dir):
    out = table(spark, sf_dir, "pages").select("page_id", reports.ids_in_text(F.col("url")).alias("ids")).where("size(ids) > 0")
    return out.select("page_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


_LANG_LIST = ", ".join(f"({k}, '{x}')" for k, x in enumerate(LANGS))


@query(f"WITH l(place, label) AS (VALUES {_LANG_LIST}), c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), j AS (SELECT place, label, coalesce(n, 0) AS n FROM l LEFT JOIN c ON lang = label) SELECT place, label, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS share FROM j")
def class_distribution(spark, sf_dir):
    return eda.class_distribution(table(spark, sf_dir, "documents"), "lang", LANGS)


def working(spark, sf_dir):
    return eda.working_text(pairs(spark, sf_dir), "source_text", "current_translation")


_WORKING = f"{PAIRS}, w AS (SELECT *, lower({strip_sql('current_translation')}) NOT IN ('', 'nan') AS ok, {strip_sql('source_text')} AS o, {strip_sql('current_translation')} AS e FROM pairs), v AS (SELECT *, CASE WHEN ok THEN e ELSE o END AS k FROM w)"


@query(f"WITH {_WORKING} SELECT label, count(*) AS n, sum(ok::INT)::BIGINT AS n_translated, round(avg(length(o)), 6) AS mean_chars_en, round(avg({sentences_sql('o')}), 6) AS mean_sentences_en, round(avg(length(e)), 6) AS mean_chars_es, round(avg({sentences_sql('e')}), 6) AS mean_sentences_es,"
       f" round(avg(length(k)), 6) AS mean_chars_working, round(avg({sentences_sql('k')}), 6) AS mean_sentences_working FROM v GROUP BY label")  # fmt: skip
def status_text_summary(spark, sf_dir):
    out = eda.text_summary(working(spark, sf_dir), "label")
    return out.select("label", "n", "n_translated", *(F.round(c, 6).alias(c) for c in out.columns[3:]))


@query(f"WITH {_WORKING} SELECT ok AS is_translated, count(*) AS n FROM v GROUP BY ok")
def translation_status(spark, sf_dir):
    return working(spark, sf_dir).groupBy("is_translated").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_WORKING} SELECT row_id, ok AS is_translated, CASE WHEN ok THEN 'es' ELSE 'en' END AS working_language, md5(k) AS working FROM v")
def working_text(spark, sf_dir):
    return working(spark, sf_dir).select("row_id", "is_translated", "working_language", F.md5("statement_working").alias("working"))


@query("SELECT 'doc_id' AS \"column\", count(*) AS n_rows, count(d.doc_id) AS n_filled, 0 AS n_null FROM documents d UNION ALL SELECT 'quality', count(*), count(quality), count(*) - count(quality) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
       " UNION ALL SELECT 'toxic', count(*), count(toxic), count(*) - count(toxic) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")  # fmt: skip
def null_audit(spark, sf_dir):
    return eda.null_audit(table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left"))


@query("SELECT d.doc_id, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_nulls(spark, sf_dir):
    return reports.any_null_dropped(table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")).select("doc_id", "quality")


def _describe_sql(name: str, c: str) -> str:
    return f"SELECT '{name}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, quantile_cont({c}, 0.25)::DOUBLE AS q25, quantile_cont({c}, 0.5)::DOUBLE AS q50, quantile_cont({c}, 0.75)::DOUBLE AS q75, max({c})::DOUBLE AS max FROM documents"


@query(f"{_describe_sql('chars', 'length(text)')} UNION ALL {_describe_sql('sentences', sentences_sql('text'))}")
def describe_lengths(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(F.length("text").alias("chars"), T.count_sentences(F.col("text")).alias("sentences"))
    return eda.describe(df, ["chars", "sentences"]).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS k FROM documents WHERE length(text) > 1000) WHERE k = 1")
def sample_per_class(spark, sf_dir):
    return eda.sample_per_class(table(spark, sf_dir, "documents").where(F.length("text") > 1000).select("lang", "doc_id"), "lang", "doc_id")


@query("SELECT doc_id, trim(lang) AS lang FROM documents WHERE trim(lang) IN ('en', 'fr')")
def valid_label_filter(spark, sf_dir):
    return eda.valid_labels(table(spark, sf_dir, "documents"), "lang", ("en", "fr")).select("doc_id", "lang")


@query(rf"WITH t AS (SELECT lang AS label, unnest(list_filter(string_split_regex({_CLEAN.replace('{c}', 'text')}, '\s+'), lambda x: x <> '')) AS token FROM documents), c AS (SELECT label, token, count(*) AS n FROM t GROUP BY ALL) SELECT label, token, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, token) AS place FROM c QUALIFY place <= 25")
def token_frequency_top_k(spark, sf_dir):
    return eda.token_frequencies(table(spark, sf_dir, "documents"), "lang", T.tokens(F.col("text")), 25)


@query("WITH l(given) AS (VALUES ('en-uk'), ('ES_ar'), ('pt-br'), (''), ('es'), ('a-b-c'), (' fr-FR ')), n(given, locale, description, name) AS (VALUES ('en-uk', 'en-GB', 'English as used in United Kingdom (en-GB)', 'statement_en_gb'), ('ES_ar', 'es-AR', 'Spanish as used in Argentina (es-AR)', 'statement_es_ar'),"
       " ('pt-br', 'pt-BR', 'Portuguese as used in BR (pt-BR)', 'statement_pt_br'), (' fr-FR ', 'fr-FR', 'French as used in FR (fr-FR)', 'statement_fr_fr')) SELECT l.given, locale, description, name FROM l LEFT JOIN n ON l.given = n.given")  # fmt: skip
def locale_metadata(spark, sf_dir):
    df = spark.createDataFrame([(x,) for x in ("en-uk", "ES_ar", "pt-br", "", "es", "a-b-c", " fr-FR ")], "given string").withColumn("locale", locales.normal_locale(F.col("given")))
    return df.select("given", "locale", locales.locale_details(F.col("locale"))["locale_description"].alias("description"), locales.translated_column(F.col("locale")).alias("name"))


@query()
def sentence_fragments(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.fragments_column(F.col("text"))).alias("place", "fragment"))


@query()
def chunk_text_500(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.chunks_column(F.col("text"), 500)).alias("place", "chunk"))


@query()
def split_long_fragment(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.pieces_column(F.col("text"), 500)).alias("place", "piece"))


@query(f"WITH {PAIRS} SELECT row_id, md5(lower({strip_sql('source_text')})) AS cell, 'success' AS state FROM pairs WHERE {strip_sql('current_translation')} = ''")
def stub_translate(spark, sf_dir):
    ship(spark)
    todo = reports.pending(output_table(spark, sf_dir), "cell")
    return translate.translated(todo, translate.whispering_backend).select("row_id", F.md5("new_text").alias("cell"), "state")


@query()
def adaptive_backoff(spark, sf_dir):
    """All documents and whole texts: batches halve, and single rows that still fail are rescued in chunks, which SQL cannot."""
    ship(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), F.col("text").alias("source_text"))
    return translate.translated(docs, translate.failing_over(900)).select("row_id", F.md5("new_text").alias("cell"), "state")


@query()
def chunked_rescue(spark, sf_dir):
    ship(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("source_text"))
    return translate.translated_in_chunks(docs, translate.failing_over(200), TranslateConfig()).select("row_id", F.length("new_text").alias("n"), "state")


@query("WITH t AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))) AS term FROM documents) SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) + 1, 9) AS idf FROM t GROUP BY term")
def tfidf_terms(spark, sf_dir):
    return ml.document_frequencies(table(spark, sf_dir, "documents"), "text").withColumn("idf", F.round("idf", 9))


@query("SELECT lang AS label, count(*) AS n, max(count(*)) OVER () AS target, max(count(*)) OVER () - count(*) AS added FROM documents GROUP BY lang")
def oversample_counts(spark, sf_dir):
    return ml.oversample_plan(table(spark, sf_dir, "documents"), "lang")


@query("SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) <= ceil((SELECT count(*) FROM documents) * 0.2::DOUBLE) AS in_test FROM documents")
def train_test_split(spark, sf_dir):
    return ml.split_exactly(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query()
def porter_stem(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(stems(T.tokens(F.col("text"))), " ").alias("tokens_stemmed"))


#: A fixed prediction: English for every fourth document, else the language itself.
_SAID = "(SELECT lang AS a, CASE WHEN doc_id % 4 = 0 THEN 'en' ELSE lang END AS p FROM documents)"


def fixed_prediction(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("a"), F.when(F.col("doc_id") % 4 == 0, "en").otherwise(F.col("lang")).alias("p"))


@query(f"WITH d AS {_SAID}, l AS (SELECT a AS x FROM d UNION SELECT p FROM d) SELECT i.x AS actual, j.x AS predicted, (SELECT count(*) FROM d WHERE a = i.x AND p = j.x) AS n FROM l i, l j")
def confusion_matrix(spark, sf_dir):
    return eda.confusion(fixed_prediction(spark, sf_dir), "a", "p")


@query(f"""WITH d AS {_SAID}, l AS (SELECT DISTINCT a AS label FROM d), e AS (SELECT label, (SELECT count(*) FROM d WHERE a = label AND p = label)::DOUBLE AS tp, (SELECT count(*) FROM d WHERE a = label) AS support, (SELECT count(*) FROM d WHERE p = label) AS said FROM l),
r AS (SELECT label, tp, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM e), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM r)
SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, support FROM f UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), sum(support)::BIGINT FROM f UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9), round(sum(f * support) / sum(support), 9), sum(support)::BIGINT FROM f""")
def classification_report(spark, sf_dir):
    return eda.classification_report(fixed_prediction(spark, sf_dir), "a", "p").withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


def _evaluation(spark, sf_dir, names: list[str]) -> DataFrame:
    """Predicts the language, with the operator's own vocabulary and rounds."""
    docs = table(spark, sf_dir, "documents").withColumn("n_sentences", T.count_sentences(F.col("text")))
    return ml.evaluated(docs, "doc_id", "text", "lang", ["n_chars", "n_sentences"], names)


@query()
def nb_eval(spark, sf_dir):
    return ml.comparison(_evaluation(spark, sf_dir, ["bernoulli_nb"]))


@query()
def tree_eval(spark, sf_dir):
    return ml.comparison(_evaluation(spark, sf_dir, ["decision_tree"]))


@query()
def logreg_eval(spark, sf_dir):
    return ml.comparison(_evaluation(spark, sf_dir, ["logistic_regression"]))


@query()
def gbt_eval(spark, sf_dir):
    return ml.comparison(_evaluation(spark, sf_dir, ["gradient_boosting"]))


@query()
def classifier_comparison(spark, sf_dir):
    return ml.comparison(_evaluation(spark, sf_dir, ["bernoulli_nb", "decision_tree", "logistic_regression", "gradient_boosting"]))


@query("SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents")
def row_numbers(spark, sf_dir):
    return reports.numbered(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "place")


@query(f"WITH {PAIRS}, n AS (SELECT row_id, label, (row_number() OVER (ORDER BY row_id) - 1) // 8 + 1 AS batch_no FROM pairs WHERE {strip_sql('current_translation')} = '') SELECT row_id, label FROM n WHERE batch_no <= 3")
def first_batches(spark, sf_dir):
    return reports.batched(reports.pending(output_table(spark, sf_dir), "cell"), 8).where("batch_no <= 3").select("row_id", "label")


@query("SELECT doc_id AS row_id, lang AS label, length(text) AS text_length, 'no answer' AS reason FROM documents")
def failed_rows(spark, sf_dir):
    return reports.failed_rows(output_table(spark, sf_dir), F.lit("no answer"), F.lit("")).drop("source_text", "logged_at")


_IDS = "CASE doc_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'x' || doc_id ELSE ' ' || doc_id || ' ' END"


@query(f"WITH d AS (SELECT d.doc_id, {_IDS} AS given, l.doc_id IS NOT NULL AS there, CASE WHEN d.doc_id % 7 = 0 THEN ' ' ELSE d.text END AS t FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) SELECT doc_id, CASE WHEN trim(given) = '' THEN 'missing_row_id' WHEN NOT regexp_matches(trim(given), '^[0-9]+$') THEN 'invalid_row_id' WHEN NOT there THEN 'missing_row' WHEN trim(t) = '' THEN 'missing_source_text' END AS state, CASE WHEN regexp_matches(trim(given), '^[0-9]+$') THEN trim(given)::BIGINT END AS parsed FROM d".replace(_IDS, _IDS.replace("doc_id", "d.doc_id")))
def terminal_states(spark, sf_dir):
    i = F.col("doc_id")
    given = F.when(i % 5 == 0, " ").when(i % 5 == 1, F.concat(F.lit("x"), i)).otherwise(F.concat(F.lit(" "), i, F.lit(" ")))
    known = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("there"))
    docs = table(spark, sf_dir, "documents").select("doc_id", given.alias("given"), F.when(i % 7 == 0, " ").otherwise(F.col("text")).alias("t")).join(known, "doc_id", "left")
    return docs.select("doc_id", reports.terminal_state(F.col("given"), F.col("there"), F.col("t")).alias("state"), reports.parsed_id(F.col("given")).alias("parsed"))


@query("SELECT row_id, arg_max(v, pos) AS v FROM (SELECT doc_id AS row_id, doc_id AS pos, lang AS v FROM documents UNION ALL SELECT doc_id, 1000000 + doc_id, quality::VARCHAR FROM labels) GROUP BY row_id")
def last_by_id(spark, sf_dir):
    first = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("doc_id").alias("pos"), F.col("lang").alias("v"))
    later = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), (F.col("doc_id") + 1_000_000).alias("pos"), F.col("quality").cast("string").alias("v"))
    return reports.last_by_id(first.unionByName(later), "pos").select("row_id", "v")


@query("SELECT d.doc_id AS row_id, lang AS label FROM documents d WHERE doc_id IN (SELECT item_id FROM benchmark)")
def selected_membership(spark, sf_dir):
    ids = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_id"))
    return reports.only_selected(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label")), ids)


@query(f"WITH {PAIRS}, r AS (SELECT i.row_id, CASE WHEN i.row_id % 2 = 0 THEN ' ' ELSE 'own' END AS s, CASE WHEN i.row_id % 3 = 0 THEN '' ELSE 'l' END AS l FROM (SELECT item_id * 7 AS row_id FROM benchmark) i) SELECT r.row_id, md5(CASE WHEN trim(s) <> '' THEN s ELSE coalesce(p.source_text, '') END) AS source_text, CASE WHEN l <> '' THEN l ELSE coalesce(p.label, '') END AS label, coalesce(p.row_id IS NOT NULL, false) AS there FROM r LEFT JOIN pairs p ON p.row_id = r.row_id")
def report_fallbacks(spark, sf_dir):
    i = F.col("row_id")
    report = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 7).alias("row_id")).withColumns({"source_text": F.when(i % 2 == 0, " ").otherwise("own"), "label": F.when(i % 3 == 0, "").otherwise("l")})
    told = reports.with_fallbacks(report, output_table(spark, sf_dir), "source_text", "label")
    return told.select("row_id", F.md5("source_text").alias("source_text"), "label", F.coalesce("_there", F.lit(False)).alias("there"))


@query("SELECT doc_id AS row_id, CASE WHEN quality = 1 THEN 'success' WHEN quality = 0 THEN 'rejected_blank' ELSE 'pending' END AS action, CASE WHEN quality = 0 THEN '' ELSE 'new' END AS new_translation FROM (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)")
def review_decisions(spark, sf_dir):
    report = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.lit("new").alias("new_translation"), F.lit("pending").alias("action"))
    said = table(spark, sf_dir, "labels").where("quality IS NOT NULL").select(F.col("doc_id").alias("row_id"), (F.col("quality") == 1).alias("accepted"))
    return reports.decided(report, said)


@query("SELECT count(*) AS n_before, count_if(trim(lang) NOT IN ('en', 'fr')) AS n_invalid, count_if(trim(lang) IN ('en', 'fr')) AS n_after FROM documents")
def label_counts(spark, sf_dir):
    return eda.label_counts(table(spark, sf_dir, "documents"), "lang", ("en", "fr"))


@query(f"WITH {PAIRS} SELECT count(*) AS translated_rows_total FROM pairs WHERE {strip_sql('current_translation')} <> ''")
def translated_rows_total(spark, sf_dir):
    return eda.filled_count(output_table(spark, sf_dir), "cell")


@query("SELECT source, min(doc_id) AS place FROM documents GROUP BY source")
def distinct_in_order(spark, sf_dir):
    return eda.in_first_order(table(spark, sf_dir, "documents"), "source", "doc_id")


@query("SELECT row_id, p.list AS list, p.pos AS \"at\" FROM (SELECT row_id, min({'list': l, 'pos': pos}) AS p FROM (SELECT doc_id % 50 AS row_id, 0 AS l, doc_id AS pos FROM labels UNION ALL SELECT item_id, 1, item_id FROM benchmark) GROUP BY row_id)")
def ordered_id_union(spark, sf_dir):
    place = lambda k, c: F.struct(F.lit(k).alias("list"), F.col(c).alias("at")).alias("place")
    first, more = table(spark, sf_dir, "labels").select((F.col("doc_id") % 50).alias("row_id"), place(0, "doc_id")), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_id"), place(1, "item_id"))
    return eda.in_first_order(first.unionByName(more), "row_id", "place").select("row_id", "place.*")


@query("SELECT 'doc_id' AS \"column\", 'bigint' AS dtype, count(*) AS n_rows, count(doc_id) AS n_filled FROM documents UNION ALL SELECT 'lang', 'string', count(*), count(lang) FROM documents UNION ALL SELECT 'text', 'string', count(*), count(text) FROM documents")
def column_types(spark, sf_dir):
    return eda.column_types(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


@query(f"WITH {PAIRS} SELECT count(*) AS updated, 0 AS empty, 0 AS failed, count(*) AS total FROM pairs WHERE {strip_sql('current_translation')} = ''")
def run_counters(spark, sf_dir):
    return reports.run_counters(translate.translated(reports.pending(output_table(spark, sf_dir), "cell"), translate.whispering_backend))


@query(f"WITH d AS {_SAID}, l AS (SELECT a AS x FROM d UNION SELECT p FROM d), m AS (SELECT i.x AS actual, j.x AS predicted, (SELECT count(*) FROM d WHERE a = i.x AND p = j.x) AS n FROM l i, l j) SELECT *, CASE WHEN sum(n) OVER (PARTITION BY actual) > 0 THEN round(n / sum(n) OVER (PARTITION BY actual), 9) ELSE 0 END AS share FROM m")
def confusion_heatmap(spark, sf_dir):
    return eda.heatmap(eda.confusion(fixed_prediction(spark, sf_dir), "a", "p")).withColumn("share", F.round("share", 9))


@query("WITH n AS (SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS k FROM documents), t AS (SELECT *, max(n) OVER () AS top FROM n) SELECT doc_id, lang, top // n + CASE WHEN k <= top % n THEN 1 ELSE 0 END AS copies FROM t")
def oversampled_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ml.oversampled(docs, "lang", "doc_id").groupBy("doc_id", "lang").agg(F.count(F.lit(1)).alias("copies"))


@query(f"WITH {PAIRS} SELECT row_id, md5(CASE WHEN {strip_sql('current_translation')} = '' THEN lower({strip_sql('source_text')}) ELSE current_translation END) AS cell FROM pairs")
def first_pass(spark, sf_dir):
    after, _ = passes.first_pass(output_table(spark, sf_dir), translate.whispering_backend, "cell")
    return after.select("row_id", F.md5("cell").alias("cell"))


@query(f"WITH {PAIRS}, q AS (SELECT doc_id, lang FROM documents d JOIN labels l USING (doc_id)) SELECT CASE WHEN doc_id % 11 = 0 THEN 'x' ELSE doc_id::VARCHAR END AS row_id, lang AS label FROM q JOIN pairs p ON p.row_id = q.doc_id WHERE doc_id % 11 = 0 OR {strip_sql('current_translation')} <> ''")
def queue_pass(spark, sf_dir):
    """The queue that is left when a second pass has translated its blank rows."""
    known = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    queue = known.select(F.when(F.col("doc_id") % 11 == 0, F.lit("x")).otherwise(F.col("doc_id").cast("string")).alias("row_id"), F.col("lang").alias("label"))
    return passes.queue_pass(output_table(spark, sf_dir), queue, translate.whispering_backend, "cell")[1]


@query(f"WITH {REPORT}, l AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'success' ELSE 'pending' END AS a FROM labels) SELECT row_id, suspicion_score, CASE WHEN l.doc_id IS NULL THEN '' ELSE 'kept' END AS new_translation, coalesce(l.a, 'pending') AS action FROM report LEFT JOIN l ON l.doc_id = row_id")
def reevaluate_dry_run(spark, sf_dir):
    old = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), F.lit("kept").alias("new_translation"), F.when(F.col("quality") == 1, " retranslated").otherwise("flagged").alias("action"))
    return passes.reevaluate(output_table(spark, sf_dir), old, None, "cell")[1].select("row_id", "suspicion_score", "new_translation", "action")


@query(f"WITH {_SELECTED} SELECT row_id, label, CASE WHEN action = 'missing_row' THEN action ELSE 'success' END AS action FROM picked")
def selected_pass(spark, sf_dir):
    """Chosen rows, emptied first and translated again."""
    out = output_table(spark, sf_dir)
    ids = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 7).alias("row_id")).union(spark.range(-1, 0).toDF("row_id"))
    return passes.selected_pass(ids, out.drop("cell"), out.where("row_id % 5 <> 0"), None, translate.whispering_backend, "cell", blank_on_start=True)[1].select("row_id", "label", "action")


@query(f"""WITH {SURE} SELECT row_id, 'success' AS action, label FROM named WHERE high_confidence_reason IS NOT NULL""")
def high_confidence_pass(spark, sf_dir):
    sure = qa.sure_report(qa.suspicious(pairs(spark, sf_dir)))
    return passes.rerun_report(output_table(spark, sf_dir), sure, "high-confidence", translate.whispering_backend, "cell")[1].select("row_id", "action", "label")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN md5(trim(lang)) WHEN doc_id % 3 = 1 THEN md5('```' || lang || '```') ELSE md5('```csv' || chr(10) || lang) END AS inside FROM documents")
def fences(spark, sf_dir):
    i, x = F.col("doc_id") % 3, F.col("lang")
    given = F.when(i == 0, F.concat(F.lit(" ```json\n "), x, F.lit("\n\n``` "))).when(i == 1, F.concat(F.lit("```"), x, F.lit("```"))).otherwise(F.concat(F.lit("```csv\n"), x))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.without_fence(given)).alias("inside"))
