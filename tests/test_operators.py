"""Operators on small tables, and every query against its SQL on the smallest driver tables."""

import glob
import hashlib
import io
import json
import os
import threading

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.config import TranslateConfig
from corpusloom.functions import text as T
from corpusloom.functions.chunking import chunks_of
from corpusloom.operators import bins, boosting, eda, ml, qa, reports, terms, translate, tree
from corpusloom.plans import passes
from corpusloom.queries import QUERIES, SQL
from corpusloom.shipping import ship
from corpusloom.sources import tables
from corpusloom.streaming.resume import translate_available

SF = "/root/testdata/sf0.001"
SLOW = {"logreg_eval", "gbt_eval", "classifier_comparison"}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def as_text(v):
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    result = oracle.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted([as_text(v) for v in r] for r in result.fetchall()) == sorted([as_text(r[n]) for n in names] for r in df.collect())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def pair(spark, source, target):
    return spark.createDataFrame([(1, "l", source, target)], "row_id long, label string, source_text string, current_translation string")


@pytest.mark.parametrize(
    ("source", "target", "score", "reasons"),
    [
        (("abcd " * 20)[:-1] + ".", "wxyz " * 3 + "wxyz.", 55, "char_ratio_too_low:0.20;word_ratio_too_low:0.20"),
        ("y" * 9 + " " + "the my you " * 9, "the my you " * 9 + "and or", 65, "english_residue:1.00"),
        ("Aa. Bb. Cc.", "aa bb cc", 10, "sentence_collapse"), ("aaaa bbbb", "aa. bb. cc.", 10, "sentence_expansion"),
        ("Meet 10 on 2020 see www.X.org iPhone", "nada que ver con esto nunca jamás ya", 90, "sentence_collapse;anchor_loss:4/4"),
    ],
)
def test_suspicion_golden(spark, source, target, score, reasons):
    r = qa.suspicious(pair(spark, source, target)).first()
    assert (r["suspicion_score"], r["reasons"]) == (score, reasons)


def test_suspicion_needs_both_texts(spark):
    assert qa.suspicious(pair(spark, "some text", " ")).count() == 0 and qa.suspicious(pair(spark, None, "x")).count() == 0


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, "severe_shortening_and_sentence_collapse"), ({"source_sentences": 2, "translated_sentences": 2, "sentence_ratio": "1.0000", "anchor_count": 4, "missing_anchor_count": 4, "anchor_miss_ratio": "1.0000"}, "severe_shortening_and_anchor_loss"),
        ({"source_sentences": 2, "translated_sentences": 2, "sentence_ratio": "1.0000", "reasons": "word_ratio_too_low:0.25"}, "severe_shortening"), ({"char_ratio": "0.5000", "anchor_count": 4, "missing_anchor_count": 4, "anchor_miss_ratio": "1.0000", "reasons": "sentence_collapse"}, "sentence_collapse_and_anchor_loss"),
        ({"char_ratio": "0.4500", "translated_chars": 180}, "severe_sentence_collapse"), ({"char_ratio": "0.4525", "translated_chars": 181}, None), ({"reasons": "english_residue:0.5"}, None), ({"source_chars": 119}, None), ({"source_words": 24}, None), ({"char_ratio": "x"}, None), ({"spacing_quality_low": "True"}, None),
    ],
)
def test_sure_golden(spark, change, want):
    row = {"source_chars": 400, "translated_chars": 100, "source_words": 80, "source_sentences": 8, "translated_sentences": 2, "char_ratio": "0.2500", "word_ratio": "0.2500", "sentence_ratio": "0.2500", "anchor_count": 0, "missing_anchor_count": 0, "anchor_miss_ratio": "0.0000", "spacing_quality_low": "False", "reasons": "char_ratio_too_low:0.25"} | change
    assert spark.createDataFrame([row]).select(qa.sure_reason().alias("x")).first()["x"] == want


def test_align_raises(spark):
    ids = lambda *x: spark.createDataFrame([(i, f"t{i}") for i in x], "row_id long, cell string")
    assert {r["row_id"]: r["cell"] for r in reports.aligned(ids(0, 1, 2).drop("cell"), ids(2, 0, 1), "cell").collect()} == {0: "t0", 1: "t1", 2: "t2"}
    for output in (ids(0, 0, 1), ids(0, 1, 9), ids(0, 1)):
        with pytest.raises(ValueError):
            reports.aligned(ids(0, 1, 2).drop("cell"), output, "cell")


def test_reports(spark):
    df = spark.createDataFrame([(None, None, "s"), ("x", True, "s"), ("1", None, "s"), ("2", True, " "), ("3", True, "s")], "row_id string, there boolean, source_text string")
    assert [r[0] for r in df.select(reports.terminal_state(F.col("row_id"), F.col("there"), F.col("source_text"))).collect()] == ["missing_row_id", "invalid_row_id", "missing_row", "missing_source_text", None]
    last = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (None, 2, "c")], "row_id long, pos long, v string")
    assert [tuple(r) for r in reports.last_by_id(last, "pos").collect()] == [(1, 1, "b")]
    assert reports.clean_names(spark.createDataFrame([(1, 2, 3)], [" a", "b ", "a"])).columns == ["a", "b"]
    report = spark.createDataFrame([(1, "new", "pending"), (2, "new", "pending"), (3, "n", "pending")], "row_id long, new_translation string, action string")
    told = reports.decided(report, spark.createDataFrame([(1, True), (2, False)], "row_id long, accepted boolean"))
    assert {r["row_id"]: (r["new_translation"], r["action"]) for r in told.collect()} == {1: ("new", "success"), 2: ("", "rejected_blank"), 3: ("n", "pending")}
    assert spark.createDataFrame([("7, 3 7\n12a5",)], "t string").select(reports.ids_in_text(F.col("t"))).first()[0] == [7, 3, 12, 5]


def test_translate_control():
    config = TranslateConfig()
    sizes = []

    def failing(prompt):
        sizes.append(prompt.count('"row_id"'))
        raise ValueError("no")

    rows = [{"row_id": k, "label": "", "source_text": "x"} for k in range(8)]
    assert all(s.startswith("failed:") for _, _, s, _ in translate.run_batches(rows, failing, config))
    assert [s for s in sizes if s][:4] == [8, 4, 2, 1]
    assert [translate.next_limit(500, 500, 80), translate.next_limit(250, 250, 80), translate.next_limit(125, 125, 80)] == [250, 125, 80]
    text = "One two three. " * 100
    assert translate.in_chunks(text, translate.failing_over(130), config).split() == text.lower().split()
    for bad in ([(1, "a")], [(1, "a"), (1, "b")], [(1, "a"), (3, "b")], [(1, "a"), (2, " ")]):
        with pytest.raises(ValueError):
            translate.checked([1, 2], bad)
    assert translate.parsed_response('```json\n[{"row_id": 1, "translation": "á"}]\n```', "json") == [(1, "á")]
    for bad, kind in (("a,b\n1,2", "csv"), ("row_id,translation\n", "csv"), ("row_id,translation\nx,y", "csv"), ("{}", "json"), ('[{"row_id": "1"}]', "json")):
        with pytest.raises(ValueError):
            translate.parsed_response(bad, kind)
    with pytest.raises(ValueError):
        translate.http_backend("http://127.0.0.1:9/none", TranslateConfig(timeout_s=0.2))("x")


def test_passes(spark):
    output = spark.createDataFrame([(1, "a", "SOME Text here.", ""), (2, "b", "Other", "done"), (3, "c", "WORD " * 400, " ")], "row_id long, label string, source_text string, cell string")
    after, queue = passes.first_pass(output, translate.failing_over(300), "cell", TranslateConfig(batch_size=2))
    assert {r["row_id"]: r["cell"][:9] for r in after.collect()} == {1: "some text", 2: "done", 3: "word word"} and queue.count() == 0
    left = spark.createDataFrame([("1", "r"), ("x", "r")], "row_id string, reason string")
    after, rest = passes.queue_pass(output, left, translate.whispering_backend, "cell")
    assert [r["row_id"] for r in rest.collect()] == ["x"]
    bad = output.withColumn("cell", F.lit("x"))
    _, dry = passes.reevaluate(bad, None, None, "cell")
    after, report = passes.reevaluate(bad, dry, translate.whispering_backend, "cell")
    assert dry.count() == report.count() > 0 and {r["action"] for r in report.collect()} == {"success"}
    picked = reports.selected_report(spark.createDataFrame([(3,), (9,)], "row_id long"), output, output, "cell")
    _, told = passes.rerun_report(output, picked, "selected", translate.whispering_backend, "cell")
    assert {r["row_id"]: r["action"] for r in told.collect()} == {3: "success", 9: "missing_row"}


def counted(folder):
    """A stand-in model that notes its calls in a folder, and answers otherwise each time."""

    def call(prompt):
        import os
        import tempfile

        fd, name = tempfile.mkstemp(dir=str(folder))
        os.close(fd)
        if "WORD" in prompt:
            raise ValueError("no")
        return translate.whispering_backend(prompt).replace("some", os.path.basename(name))

    return call


def test_each_row_is_asked_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    calls = lambda: len(os.listdir(tmp_path / "calls"))
    output = spark.createDataFrame([(1, "a", "SOME Text here.", ""), (2, "b", "Other", "done")], "row_id long, label string, source_text string, cell string").coalesce(1)
    after, queue = passes.first_pass(output, counted(tmp_path / "calls"), "cell")
    assert [after.count(), queue.count(), after.count()] == [2, 0, 2] and len(after.collect()) == 2 and calls() == 1
    bad = output.withColumn("cell", F.lit(" "))
    after, rest = passes.queue_pass(bad, spark.createDataFrame([("1", "r"), ("2", "r")], "row_id string, reason string"), counted(tmp_path / "calls"), "cell", every=1)
    assert [after.count(), rest.count()] == [2, 0] and after.collect() == after.collect() and calls() == 3


def test_selected_pass(spark):
    """Fallbacks, review, batches of rows, cells emptied first."""
    output = spark.createDataFrame([(k, "lab", f"TEXT number {k}", "old" if k < 4 else "") for k in range(6)], "row_id long, label string, source_text string, cell string")
    ids, seen = spark.createDataFrame([(0,), (4,), (5,), (9,)], "row_id long"), []
    run = lambda **more: passes.selected_pass(ids, output, output, None, translate.whispering_backend, "cell", **more)
    after, report = run(every=1, flush=lambda done: seen.append(reports.run_counters(done).first().asDict()))
    assert {r["row_id"]: r["action"] for r in report.collect()} == {0: "success", 4: "success", 5: "success", 9: "missing_row"} and [s["updated"] for s in seen] == [1, 1]
    assert {r["row_id"]: r["cell"] for r in after.collect()}[0] == "old"
    said = spark.createDataFrame([(4, False), (5, True)], "row_id long, accepted boolean")
    after, report = run(blank_on_start=True, decisions=said)
    assert {r["row_id"]: r["cell"] for r in after.collect()} == {0: "text number 0", 1: "old", 2: "old", 3: "old", 4: "", 5: "text number 5"}
    assert {r["row_id"]: r["action"] for r in report.collect()} == {0: "success", 4: "rejected_blank", 5: "success", 9: "missing_row"}
    after, _ = run(force=True)
    assert {r["row_id"]: r["cell"] for r in after.collect()}[0] == "text number 0"
    lacking = spark.createDataFrame([(1, "", " ", "pending")], "row_id long, label string, source_text string, action string").withColumn("new_translation", F.lit(""))
    _, told = passes.rerun_report(output, lacking, "high-confidence", translate.whispering_backend, "cell")
    assert [tuple(r) for r in told.select("label", "source_text", "new_translation", "action").collect()] == [("lab", "TEXT number 1", "text number 1", "success")]


def test_second_passes_have_a_floor(monkeypatch, spark):
    found = []
    monkeypatch.setattr(translate, "replace", lambda config, **change: found.append(change) or config)
    translate.translated_in_chunks(spark.createDataFrame([(1, "x")], "row_id long, source_text string"), translate.whispering_backend, TranslateConfig(min_chunk_chars=5))
    assert found == [{"min_chunk_chars": 40}]


def test_model_rests(monkeypatch):
    rests = []
    monkeypatch.setattr(translate.time, "sleep", rests.append)
    with pytest.raises(ValueError):
        translate.http_backend("http://127.0.0.1:9/none", TranslateConfig(timeout_s=0.2, sleep_s=1.5))("x")
    assert rests == [1.5]


def test_batches_beyond_the_sample(spark):
    """More rows than range partitioning samples, with more columns: every batch is full, in order."""
    df = spark.range(0, 400_000, numPartitions=4).select(F.pmod(F.col("id") * 7919, F.lit(400_000)).alias("row_id"), F.repeat(F.lit("x"), 20).alias("more"))
    bounds = reports.batched(df, 8).groupBy("batch_no").agg(F.min("row_id").alias("first"), F.max("row_id").alias("last"), F.count(F.lit(1)).alias("n"))
    assert bounds.count() == 50_000 and bounds.where("n <> 8 OR first <> (batch_no - 1) * 8 OR last <> batch_no * 8 - 1").isEmpty()


def test_exact_quantiles(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select((F.pmod(F.col("id") * 37, F.lit(11)) / 4).alias("x"), F.lit(None).cast("double").alias("e"))
        values = sorted(r["x"] for r in df.collect())
        assert eda.quantiles(df, "x") == [pytest.approx(float(pd.Series(values).quantile(q))) for q in (0.25, 0.5, 0.75)] and eda.quantiles(df, "e") == [None] * 3


def test_split_without_sorting(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("_h"))
    for share in (0.0, 0.2, 0.337, 1.0):
        parts = ml.split_exactly(df, "k", share)
        rows = sorted((hashlib.md5(str(r["k"]).encode()).hexdigest(), r["in_test"]) for r in parts.collect())
        n = -int(-5000 * share // 1)
        assert [t for _, t in rows] == [True] * n + [False] * (5000 - n) and parts.columns == ["k", "_h", "in_test"]


def test_command_lines(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / "in.csv").write_text("\ufeff,statement,status\n" + "".join(f'{k},"I FEEL number {k}, and so on.",Stress\n' for k in range(6)) + "6,WORD up,Normal\n", encoding="utf-8")
    (tmp_path / "calls").mkdir()
    path = lambda name: str(tmp_path / name)
    run = lambda *words: cli.main([*words, "--output", path("out"), "--sleep-seconds", "0"], spark, lambda config: counted(tmp_path / "calls"))
    files = ("--input", path("in.csv"), "--failed-rows-file", path("queue"), "--checkpoint", path("state"))
    assert run("translate", *files, "--max-batches", "1", "--batch-size", "2") == 0 and run("translate", *files) == 1 and run("translate", *files, "--skip-unrecoverable") == 0
    out = {r["row_id"]: r for r in tables.read_strings(spark, path("out")).collect()}
    assert set(out["0"].asDict()) == {"row_id", "statement", "status", "statement_es_es"} and out["5"]["statement_es_es"] == "i feel number 5, and so on." and out["6"]["statement_es_es"] == ""
    assert [r["row_id"] for r in tables.read_strings(spark, path("queue")).collect()] == ["6"] and tables.read_checkpoint(spark, path("state"))["translated_rows_total"] == 6
    assert run("second-pass", "--problematic-file", path("queue")) == 0 and tables.read_strings(spark, path("queue")).count() == 1
    report = ("--report-file", path("report"), "--high-confidence-report-file", path("sure"))
    assert run("second-pass", "--mode", "reevaluate", "--dry-run", "--max-english-token-ratio", "0.01", *report) == 0
    assert tables.read_strings(spark, path("report")).columns == qa.REPORT and tables.read_strings(spark, path("report")).count() == 6
    assert run("second-pass", "--mode", "high-confidence-report", *report) == 0 and run("second-pass", "--mode", "high-confidence-retranslate", *report) == 0
    assert run("selected", "--input", path("in.csv"), "--row-ids", "1, 6 77", "--report-file", path("chosen"), "--blank-on-start") == 0
    assert {r["row_id"]: r["action"][:7] for r in tables.read_strings(spark, path("chosen")).collect()} == {"1": "success", "6": "failed:", "77": "missing"}
    with pytest.raises(SystemExit):
        run("translate", *files, "--batch-size", "0")
    with pytest.raises(SystemExit):
        run("selected", "--input", path("in.csv"))


def test_csv_and_ods(spark, tmp_path):
    (tmp_path / "in.csv").write_text('﻿,statement , status\n0,"a ""q""\nnext, x",Stress\n1,  pad ,\n2\n', encoding="utf-8")
    df = tables.read_strings(spark, str(tmp_path / "in.csv"))
    assert df.columns == ["row_id", "statement", "status"] and sorted(map(tuple, df.collect())) == [("0", 'a "q"\nnext, x', "Stress"), ("1", "  pad ", ""), ("2", "", "")]
    tables.write_strings(df, str(tmp_path / "out"), one_file=True)
    assert sorted(map(tuple, tables.read_strings(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, df.collect()))
    assert tables.read_if_there(spark, str(tmp_path / "none")) is None
    spark.dataSource.register(tables.OdsSource)
    tables.write_ods(df, str(tmp_path / "t.ods"))
    assert sorted(map(tuple, spark.read.format("ods").load(str(tmp_path / "t.ods")).collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "ids.txt").write_text("5\n7 x5\n")
    assert [r[0] for r in tables.chosen_ids(spark, "7,1,7", str(tmp_path / "ids.txt")).collect()] == [7, 1, 5]
    tables.write_strings(df, str(tmp_path / "some"), one_file=True, columns=["status", "row_id", "more"], bom=True)
    assert next((tmp_path / "some").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfstatus,row_id,more")
    assert tables.read_strings(spark, str(tmp_path / "some")).columns == ["status", "row_id", "more"]
    with pytest.raises(ValueError):
        tables.write_strings(df, str(tmp_path / "none"), columns=["row_id"], unknown="raise")
    tables.write_report(spark.createDataFrame([(1, "r")], "row_id long, reasons string"), str(tmp_path / "report"))
    assert tables.read_strings(spark, str(tmp_path / "report")).columns == qa.REPORT
    with pytest.raises(FileExistsError):
        tables.write_report(df, str(tmp_path / "report"), rebuild=False)
    (tmp_path / "ids.csv").write_text("row_id\n4\n")
    assert [r[0] for r in tables.read_ids(spark, str(tmp_path / "ids.csv")).collect()] == [4]
    tables.write_checkpoint(spark, {"model": "m", "batch_size": 8}, str(tmp_path / "cp"))
    assert tables.read_checkpoint(spark, str(tmp_path / "cp")) == {"model": "m", "batch_size": 8} and tables.read_checkpoint(spark, str(tmp_path / "no")) == {}
    assert [tables.should_sync("a.ods", 25, 25), tables.should_sync("a.csv", 25, 25, True), tables.should_sync("a.ods", 3, 0), tables.should_sync("a.ods", 3, 0, True)] == [True, False, False, True]
    tables.write_new(df, str(tmp_path / "r"))
    with pytest.raises(Exception):  # noqa: B017
        tables.write_new(df, str(tmp_path / "r"))


def test_adaptive_backoff(spark, tmp_path):
    """All documents, long and many-lined too, against a plain loop: what fits the model in one row, else chunks of it."""
    config = TranslateConfig()
    line = "Some Words of a sentence. And Another one,\n  with two lines! "
    texts = ["Short", " outer  blanks\n\n", line * 8, line * 14, line * 16, line * 300, "Unbroken" * 400, "[starts like JSON] " + line * 40, "", "tab\tand \"quotes\", commas"]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))

    def rescued(text, limit):
        if len(text) <= 900 and not text.startswith("["):
            return text.lower().strip()
        smaller = max(config.min_chunk_chars, min(limit // 2, max(config.min_chunk_chars, len(text) // 2)))
        parts = chunks_of(text, smaller) if len(text) > config.min_chunk_chars and smaller < len(text) else []
        if len(parts) <= 1:
            raise ValueError
        return "\n\n".join(rescued(p, smaller) for p in parts)

    want = {}
    for i, text in enumerate(texts):
        body = json.dumps([{"row_id": i, "label": "en", "source_text": text}], ensure_ascii=False, indent=2)
        try:
            alone = text.strip() and len(body) <= 900
            want[i] = text.lower().strip() if alone else "\n\n".join(rescued(c, config.chunk_chars) for c in chunks_of(text, config.chunk_chars)).strip()
        except ValueError:
            want[i] = None
    got = {r["row_id"]: r for r in QUERIES["adaptive_backoff"](spark, str(tmp_path)).collect()}
    assert set(got) == set(want) and want[5] and want[5].count("\n\n") > 10
    for i, text in want.items():
        assert (got[i]["state"] == "success") == (text is not None), (i, got[i])
        assert got[i]["cell"] == hashlib.md5((text or "").encode()).hexdigest(), (i, got[i])


def test_resume(spark, tmp_path):
    schema = "row_id long, label string, source_text string"
    run = lambda: translate_available(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"), translate.whispering_backend).awaitTermination()
    spark.createDataFrame([(1, "", "A"), (2, "", "B")], schema).write.parquet(str(tmp_path / "in"))
    run()
    spark.createDataFrame([(2, "", "B"), (3, "", "C")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted((r["row_id"], r["new_text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_eda(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = eda.describe(df, ["x"]).first()
    assert (r["mean"], round(r["std"], 7), r["q25"], r["q50"], r["q75"]) == (2.5, 1.2909944, 1.75, 2.5, 3.25)
    assert eda.translation_column(["a", "statement_es", "translation"]) == "translation" and eda.translation_column(["statement_es_ar"]) == "statement_es_ar" and eda.translation_column(["x"]) is None
    text = spark.createDataFrame([("a", "NaN"), ("b", " t "), ("c", None)], "s string, t string")
    assert [r["statement_working"] for r in eda.working_text(text, "s", "t").collect()] == ["a", "t", "c"]
    assert [r["statement_working"] for r in eda.working_text(text, "s", None).collect()] == ["a", "b", "c"]
    assert [r["n"] for r in eda.class_distribution(text.limit(0), "s", T.LABELS).orderBy("place").collect()] == [0] * 7


def test_balance(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": range(1000), "y": ["a"] * 700 + ["b"] * 210 + ["c"] * 90}))
    counts = {r["y"]: r["count"] for r in ml.oversampled(df, "y", "k").groupBy("y").count().collect()}
    assert counts == {"a": 700, "b": 700, "c": 700}
    assert ml.oversampled(df, "y", "k").columns == df.columns and ml.oversampled(df.limit(0), "y", "k").count() == 0
    assert ml.split_exactly(df, "k").where("in_test").count() == 200 and ml.split_exactly(df.limit(0), "k").count() == 0


def asked_of_models(monkeypatch, spark, name):
    """What a registered query asks of ml.evaluated: names of classifiers, vocabulary, rounds."""
    asked = []

    def evaluated(df, key, text, label, numeric, names, vocabulary=ml.VOCABULARY, rounds=500):
        asked.append((sorted(names), vocabulary, rounds))
        return spark.createDataFrame([("x", 1, "a", "a")], "classifier string, doc_id long, actual string, predicted string")

    monkeypatch.setattr(ml, "evaluated", evaluated)
    QUERIES[name](spark, SF)
    return asked[0]


def sparse(table):
    return [{"indices": np.flatnonzero(r), "values": r[np.flatnonzero(r)]} if k % 2 else {"indices": None, "values": r} for k, r in enumerate(table)]


def test_boosting_split():
    """The best split of all features and values, zeros and negative ones included, against plain loops."""
    draw = np.random.default_rng(7)
    for _ in range(20):
        table = draw.integers(-3, 4, (60, 6)) * (draw.random((60, 6)) < 0.5) * 1.0
        rows, g, h = np.sort(draw.choice(60, 40, replace=False)), draw.normal(size=40), draw.uniform(0.05, 0.25, 40)
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + boosting.SHRINK)
        every = np.ones(40, bool)
        gains = [score(left) + score(~left) - score(every) for f in range(6) for t in np.unique(table[:, f])
                 for left in [table[rows, f] <= t] if min(h[left].sum(), h[~left].sum()) >= boosting.LEAST]
        feature, bound, right = boosting.Binned(sparse(table)).split(rows, g, h)
        assert (right == (table[rows, feature] > bound)).all()
        assert abs(score(right) + score(~right) - score(every) - max(gains)) < 1e-9
    assert boosting.Binned([]).split(np.empty(0, int), np.empty(0), np.empty(0)) is None


def test_boosting(spark):
    """What trees say of their own rows is what they were fitted to; a table is learned as its rule says, whatever its columns."""
    draw = np.random.default_rng(3)
    table = draw.integers(0, 3, (120, 5)) * 1.0
    y = ((table[:, 0] > 1) ^ (table[:, 2] > 0)) * 1.0
    trees = boosting.grown(boosting.Binned(sparse(table)), y, 40, 4, 0.2)
    assert ((boosting.margins(trees, sparse(table)) > 0) == (y > 0)).all()
    rows = [(i, float(c), Vectors.dense(r) if i % 2 else Vectors.sparse(5, [(j, v) for j, v in enumerate(r) if v])) for i, (r, c) in enumerate(zip(table, y, strict=True))]
    df = spark.createDataFrame(rows, ["k", "y", "features"])
    model = boosting.Boosting("k", rounds=40, depth=4).fit(df)
    assert sorted(model.models) == [0.0, 1.0]
    said = model.transform(df.withColumn("a b", F.lit(None).cast("string")))
    assert said.columns == ["k", "y", "a b", "prediction"] and said.where("y <> prediction").count() == 0
    none = boosting.Boosting("k", rounds=2).fit(df.limit(0))
    assert none.models == {} and none.transform(df.limit(2)).where("prediction IS NULL").count() == 2


def test_tree(spark, monkeypatch):
    """Every split is the best by Gini of all of the node's rows, whatever the features' number; classes as a plain tree has them."""
    rng = np.random.default_rng(3)
    table = rng.integers(-1, 6, (400, 5)) * (rng.random((400, 5)) < 0.6) * 1.0
    y = ((table[:, 1] > 2) * 1 + (table[:, 3] > 0) * 1).astype(int)

    def gini(rows):
        return sum(np.sum(y[rows] == c) ** 2 for c in range(3)) / max(len(rows), 1)

    def plain(rows, depth):
        best = max(((gini(rows[table[rows, f] <= t]) + gini(rows[table[rows, f] > t]) - gini(rows), -f, -t) for f in range(5) for t in np.unique(table[:, f])
                    if min((table[rows, f] <= t).sum(), (table[rows, f] > t).sum()) >= 2), default=(0,)) if depth else (0,)
        if best[0] <= 1e-7:
            return dict.fromkeys(rows.tolist(), int(np.argmax(np.bincount(y[rows], minlength=3))))
        f, t = -best[1], -best[2]
        return plain(rows[table[rows, f] <= t], depth - 1) | plain(rows[table[rows, f] > t], depth - 1)

    wide = [Vectors.sparse(60_000, {int(10_000 * f): float(v) for f, v in enumerate(r) if v}) for r in table]  # dense, these rows would be 190 MB
    df = spark.createDataFrame([(k, float(c), v) for k, (c, v) in enumerate(zip(y.tolist(), wide, strict=True))], ["k", "y", "features"])
    monkeypatch.setattr(tree, "HELD", 50)
    for depth in (1, 2, 9):
        got = {r["k"]: r["prediction"] for r in tree.DecisionTree("k", depth).fit(df).transform(df).collect()}
        assert got == plain(np.arange(400), depth)
    dense = spark.createDataFrame([(k, float(c), Vectors.dense(r)) for k, (c, r) in enumerate(zip(y.tolist(), table.tolist(), strict=True))], ["k", "y", "features"])
    assert [r["prediction"] for r in tree.DecisionTree("k").fit(dense).transform(dense).orderBy("k").collect()] == y.tolist()
    one = tree.DecisionTree("k").fit(df.where("y = 1")).transform(df)
    assert one.columns == ["k", "y", "prediction"] and {r[0] for r in one.select("prediction").distinct().collect()} == {1.0}
    assert [r["prediction"] for r in tree.DecisionTree("k").fit(df.limit(0)).transform(df.limit(2)).collect()] == [None, None]


def test_trees_of_all_rows(spark):
    """Rows beyond the 10 000 whose keys have the smallest hashes are fitted too, and bounds of bins know their values."""
    keys = [r["k"] for r in spark.range(10_800).withColumnRenamed("id", "k").orderBy(F.xxhash64("k"), "k").collect()]
    rows = [(k, float(i % 2), Vectors.sparse(2, [(0, 1.0 + i % 2), (1, 1.0)] if i < 10_000 else [(1, 2.0 + i % 2)])) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, ["k", "y", "features"]).persist()
    assert tree.DecisionTree("k", 3).fit(df).transform(df).where("y <> prediction").count() == 0
    assert boosting.Boosting("k", 8, 3).fit(df).transform(df).where("y <> prediction").count() == 0


def test_bounds_of_all_values(spark):
    """Bounds made by feature in the workers are those of all values at once, repeated as often as copies says."""
    rng = np.random.default_rng(11)
    table = rng.normal(size=(500, 7)) * (rng.random((500, 7)) < [0.9, 0.5, 0.1, 0.01, 0, 1, 0.3]) * [1, 1, -1, 1, 1, 1, 0.1]
    copies = rng.integers(1, 4, 500)
    rows = [(int(c), Vectors.sparse(9, [(j, v) for j, v in enumerate(r) if v]) if k % 2 else Vectors.dense([*r, 0, 0])) for k, (c, r) in enumerate(zip(copies, table.tolist(), strict=True))]
    df = spark.createDataFrame(rows, ["c", "features"]).repartition(5)
    for named, times in (("c", copies), (None, np.ones(500, int))):
        _, feature, value = bins.flat(sparse(np.repeat(table, times, axis=0)))
        got, want = bins.bounded(df, named), bins.Bins.of(feature, value, 9)
        assert all((getattr(got, k) == getattr(want, k)).all() for k in ("bounds", "starts", "zero")) and len(got.bounds) > 100
    assert len(bins.bounded(df.limit(0)).bounds) == 0


def test_boosting_shares():
    """The same trees whatever the number of tasks that share the features, and in whatever order the rows are."""
    rng = np.random.default_rng(13)
    table = rng.integers(0, 40, (600, 11)) * (rng.random((600, 11)) < 0.4) / 7
    y, copies = ((table[:, 3] > 1) ^ (table[:, 8] > 2) ^ (rng.random(600) < 0.05)) * 1.0, rng.integers(1, 3, 600)

    def trees(shares, order):
        row, feature, value = bins.flat(sparse(table[order]))
        of = bins.Bins.of(feature, value, 11, copies[order][row])
        number, said, gate, out = of.number(feature, value), [None] * shares, threading.Barrier(shares), [None] * shares

        def task(place):
            def met(mine):
                said[place] = mine
                gate.wait(60)
                every = list(said)
                gate.wait(60)
                return every

            use = feature % shares == place
            data = boosting.Binned.share(of, place, shares, 600, row[use].astype(np.int32), number[use])
            out[place] = boosting.grown(data, y[order], 60, 4, 0.3, copies[order], met, place)

        each = [threading.Thread(target=task, args=(k,)) for k in range(shares)]
        for t in each:
            t.start()
        for t in each:
            t.join(120)
        return out

    whole = trees(1, np.arange(600))[0]
    assert (whole["feature"][:5] >= 0).sum() > 30
    for other in (*trees(4, np.arange(600)), *trees(3, rng.permutation(600)), *trees(13, np.arange(600))):
        assert all((whole[k] == other[k]).all() for k in whole)


def test_terms_as_the_library(spark):
    """Terms, their IDF and vectors are those of the library's tokenizer, pairs, counts, IDF and normalizer."""
    texts = ["Der Hund und der Hund, der Hund", "", "x y z", "one", "Ünder_1 straße 中文 ab ab ab", None, "der hund beißt!! ab ab", "İstanbul ΣΑΣ der\tund"] * 2
    df = spark.createDataFrame([(k, t, float(k % 3)) for k, t in enumerate(texts)], "k long, text string, x double")
    plain = [RegexTokenizer(inputCol="text", outputCol="w", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=2), NGram(n=2, inputCol="w", outputCol="p"), SQLTransformer(statement="SELECT *, concat(w, p) AS t FROM __THIS__"),
             CountVectorizer(inputCol="t", outputCol="tf"), IDF(inputCol="tf", outputCol="idf")]
    model = Pipeline(stages=plain).fit(df.fillna(""))
    names, weights = model.stages[3].vocabulary, model.stages[4].idf.toArray() + 1
    for size in (1000, 5, 0):
        known, idf = terms.vocabulary(df, "text", size)
        counts = {t: sum([*ws, *map(" ".join, zip(ws, ws[1:], strict=False))].count(t) for r in model.stages[0].transform(df.fillna("")).collect() for ws in [r["w"]]) for t in names}
        assert known == sorted(names, key=lambda t: (-counts[t], t))[:size]
        np.testing.assert_allclose(idf, [weights[names.index(t)] for t in known])
        got = terms.vectors(df, "text", ["x"], known, idf, ["k"], "test").orderBy("k").collect()
        tf = {r["k"]: dict(zip((names[i] for i in r["tf"].indices), r["tf"].values, strict=True)) for r in model.transform(df.fillna("")).collect()}
        for r in got:
            want = np.array([tf[r["k"]].get(t, 0) for t in known]) * idf
            np.testing.assert_allclose(r["features"].toArray(), [*want / (np.sqrt((want**2).sum()) or 1), r["k"] % 3])
    with pytest.raises(Exception, match="x has nulls"):
        terms.vectors(df.withColumn("x", F.lit(None).cast("double")), "text", ["x"], known, idf, ["k"], "test")
    assert terms.vocabulary(df.limit(0), "text", 10)[0] == []


def test_terms_in_parts(monkeypatch):
    """Counts do not depend on how many words are taken at once and how many terms a task holds."""
    docs = [["ab", "cd", "ab", "cd"], [], ["cd"], ["ab"] * 9, ["ef", "ab", "cd"]]

    def counts():
        out = {}
        for b in terms.counted(iter([pa.record_batch([pa.array(docs, pa.list_(pa.string()))], names=["_w"])] * 3)):
            for r in b.to_pylist():
                n, df = out.get(r["term"], (0, 0))
                out[r["term"]] = n + r["n"], df + r["df"]
        return out

    whole = counts()
    assert whole["ab cd"] == (9, 6) and whole["ab"] == (36, 9) and whole["cd"] == (12, 9) and whole["ab ab"] == (24, 3)
    for words, held in ((1, 1), (4, 3), (6, 100)):
        monkeypatch.setattr(terms, "WORDS", words)
        monkeypatch.setattr(terms, "HELD", held)
        assert counts() == whole


def test_copies_stand_for_rows(spark):
    """Balanced rows are fitted once, with how many rows they stand for: the same trees as of repeated rows."""
    rng = np.random.default_rng(5)
    rows = [(k, float(k % 10 == 0) + float(k % 10 == 5), Vectors.sparse(4, [(j, float(v)) for j, v in enumerate(rng.integers(0, 4, 4) + (k % 5 == 0) * (rng.random(4) < 0.5)) if v])) for k in range(300)]
    df = ml.balanced(spark.createDataFrame(rows, ["k", "y", "features"]), "y", "k").persist()
    assert df.count() == 300 and df.groupBy("y").agg(F.sum("_copies").alias("n")).select("n").distinct().count() == 1
    repeated = ml.oversampled(df.drop("_copies"), "y", "k").persist()
    for one, all_ in ((tree.DecisionTree("k", 4, copies="_copies"), tree.DecisionTree("k", 4)), (boosting.Boosting("k", 5, 3, copies="_copies"), boosting.Boosting("k", 5, 3)), (boosting.Boosting("k", 5, 3, sample=100, copies="_copies"), boosting.Boosting("k", 5, 3, sample=100))):
        a, b = (getattr(m, "trees", None) or {c: dict(np.load(io.BytesIO(x))) for c, x in m.models.items()} for m in (one.fit(df), all_.fit(repeated)))
        for t, u in [(a, b)] if "feature" in a else [(a[c], b[c]) for c in (0.0, 1.0)]:
            assert (t["feature"] == u["feature"]).all() and (t["bound"] == u["bound"]).all()
            np.testing.assert_allclose(t["value"], u["value"])


def test_all_classifiers_compared(monkeypatch, spark):
    assert asked_of_models(monkeypatch, spark, "classifier_comparison")[0] == sorted(ml.classifiers(1, "k"))


@pytest.mark.parametrize("name", ["nb_eval", "tree_eval", "logreg_eval", "gbt_eval", "classifier_comparison"])
def test_evaluations_use_defaults(monkeypatch, spark, name):
    assert asked_of_models(monkeypatch, spark, name)[1:] == (50_000, 500)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
    json.dumps(e.oracle_sql())
