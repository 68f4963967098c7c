"""Command lines of the three programs: `python -m corpusloom.cli translate | second-pass | selected`.

Tables are CSV files or folders, or .ods files; outputs are written beside what they replace and put in its place, so that a
run reads one version of a table. The exit code is 1 if rows failed that --skip-unrecoverable does not allow to.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import QaThresholds, TranslateConfig
from corpusloom.functions.locales import described, output_name
from corpusloom.operators import eda, qa, reports
from corpusloom.operators.translate import Backend, http_backend
from corpusloom.plans import passes
from corpusloom.sources import tables

log = logging.getLogger("corpusloom")
QUEUE_FILE = ".translation_problematic_rows.csv"
#: Options of the limits that are named otherwise than their fields.
LIMITS = {
    "max_english_ratio": "max-english-token-ratio", "long_text": "long-text-threshold", "long_abs_tolerance": "long-text-abs-tolerance", "long_rel_tolerance": "long-text-relative-tolerance",
    "max_anchor_miss": "max-anchor-miss-ratio", "sure_char_ratio": "high-confidence-max-char-ratio", "sure_word_ratio": "high-confidence-max-word-ratio", "sure_sentence_ratio": "high-confidence-max-sentence-ratio",
    "sure_min_chars": "high-confidence-min-source-chars", "sure_min_words": "high-confidence-min-source-words",
}


def parser() -> argparse.ArgumentParser:
    """All programs, options and defaults."""
    top = argparse.ArgumentParser(prog="corpusloom", description="Translates, audits and repairs labelled text corpora.")
    programs = top.add_subparsers(dest="program", required=True)
    defaults = TranslateConfig()

    def program(name: str, about: str) -> argparse.ArgumentParser:
        p = programs.add_parser(name, help=about, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
        p.add_argument("--provider", choices=["ollama"], default="ollama")
        for option, value in (("model", defaults.model), ("source-locale", defaults.source_locale), ("target-locale", defaults.target_locale), ("base-url", ""), ("output", ""), ("source-col", "statement"), ("label-col", "status"), ("translated-col", "")):
            p.add_argument(f"--{option}", default=value)
        p.add_argument("--sleep-seconds", type=float, default=defaults.sleep_s)
        p.add_argument("--request-timeout", type=float, default=defaults.timeout_s)
        p.add_argument("--chunk-max-chars", type=int, default=defaults.chunk_chars)
        p.add_argument("--min-chunk-chars", type=int, default=defaults.min_chunk_chars)
        return p

    first = program("translate", "translate pending rows")
    for option, value in (("input", "Combined Data.csv"), ("checkpoint", ".translation_checkpoint.json"), ("rename-translated-col-from", ""), ("failed-rows-file", QUEUE_FILE)):
        first.add_argument(f"--{option}", default=value)
    first.add_argument("--response-format", choices=["json", "csv"], default=defaults.response_format)
    for option, value in (("batch-size", defaults.batch_size), ("min-batch-size", defaults.min_batch_size), ("start-row", 0), ("max-batches", 0), ("sync-output-every", 25)):
        first.add_argument(f"--{option}", type=int, default=value)
    first.add_argument("--skip-unrecoverable", action="store_true")

    second = program("second-pass", "audit a translated table and repair it")
    second.add_argument("--mode", choices=["problematic", "reevaluate", "high-confidence-report", "high-confidence-retranslate"], default="problematic")
    for option, value in (("problematic-file", QUEUE_FILE), ("report-file", ".translation_suspicious_rows.csv"), ("high-confidence-report-file", ".translation_high_confidence_mismatches.csv"), ("decisions-file", "")):
        second.add_argument(f"--{option}", default=value)
    for flag in ("rebuild-report", "blank-flagged-translations", "dry-run"):
        second.add_argument(f"--{flag}", action="store_true")
    second.add_argument("--max-rows", type=int, default=0)
    for f in fields(QaThresholds):
        second.add_argument(f"--{LIMITS.get(f.name, f.name.replace('_', '-'))}", dest=f.name, type=type(f.default), default=f.default)

    chosen = program("selected", "translate chosen rows again")
    for option, value in (("input", "Combined Data.csv"), ("row-ids", ""), ("row-ids-file", ""), ("report-file", ".translation_selected_rows_retranslation.csv"), ("decisions-file", "")):
        chosen.add_argument(f"--{option}", default=value)
    for flag in ("blank-on-start", "rebuild-report", "force"):
        chosen.add_argument(f"--{flag}", action="store_true")
    for p in (second, chosen):
        p.add_argument("--row-batch-size", "--save-every", dest="every", type=int, default=0, help="rows after which answers are kept; 0 for all at once")
    return top


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table of strings with a row_id, from CSV or the first sheet of an .ods file; without ids, rows are numbered."""
    if path.lower().endswith(".ods"):
        spark.dataSource.register(tables.OdsSource)
        df = reports.as_strings(reports.clean_names(spark.read.format("ods").load(path)))
    else:
        df = tables.read_strings(spark, path)
    if "row_id" not in df.columns:
        df = reports.numbered(df.withColumn("_order", F.monotonically_increasing_id()), "_order", "row_id").drop("_order")
    return df.withColumn("row_id", reports.parsed_id(F.col("row_id")))


def put(*results: tuple[DataFrame, str]) -> None:
    """Writes tables in place of those that they may have been read from, once all of them are there."""
    kept = [(passes.written(df, "put"), path) for df, path in results]
    for df, path in kept:
        if path.lower().endswith(".ods"):
            tables.write_ods(df, path)
        else:
            tables.write_strings(df, path, bom=True)


def _settings(args: argparse.Namespace) -> tuple[TranslateConfig, str]:
    config = TranslateConfig(chunk_chars=args.chunk_max_chars, min_chunk_chars=args.min_chunk_chars, source_locale=described(args.source_locale)[0], target_locale=described(args.target_locale)[0], model=args.model, timeout_s=args.request_timeout, sleep_s=args.sleep_seconds)
    if args.program == "translate":
        if args.batch_size < 1 or not 1 <= args.min_batch_size <= args.batch_size:
            raise SystemExit("batch sizes have to be at least 1, and the smallest no more than the largest")
        config = replace(config, batch_size=args.batch_size, min_batch_size=args.min_batch_size, response_format=args.response_format, skip_unrecoverable=args.skip_unrecoverable)
    return config, args.translated_col or "statement_" + config.target_locale.lower().replace("-", "_")


def _named(df: DataFrame, args: argparse.Namespace) -> DataFrame:
    """df with the names that the operators use for source and label."""
    return df.withColumnsRenamed({args.source_col: "source_text", args.label_col: "label"})


def _own(df: DataFrame, args: argparse.Namespace) -> DataFrame:
    return df.withColumnsRenamed({"source_text": args.source_col, "label": args.label_col})


def translate(spark: SparkSession, args: argparse.Namespace, backend: Backend, config: TranslateConfig, column: str) -> int:
    path = args.output or output_name(config.target_locale, args.input)
    source, found = read(spark, args.input), read(spark, path) if tables.exists(spark, path) else None
    if found is not None and args.rename_translated_col_from:
        found = reports.renamed_column(found, args.rename_translated_col_from, column)
    output = reports.with_column(source, column) if found is None else reports.aligned(source.drop(column), reports.with_column(found, column), column)
    after, queue = passes.first_pass(_named(output, args), backend, column, config, args.start_row, args.max_batches)
    queue, old = passes.written(queue, "queue"), tables.read_if_there(spark, args.failed_rows_file)
    put((_own(after, args), path), (reports.queue_upsert(old, reports.as_strings(queue)) if old is not None else queue, args.failed_rows_file))
    total, failed = eda.filled_count(read(spark, path), column).first()[0], queue.count()
    tables.write_checkpoint(spark, {"updated_at": spark.range(1).select(passes.now()).first()[0], "input_file": args.input, "output_file": path, "translated_col": column, "model": config.model, "batch_size": config.batch_size, "translated_rows_total": total, "last_error": f"{failed} rows failed" if failed else ""}, args.checkpoint)
    if tables.should_sync(path, 1, args.sync_output_every, force=True):
        log.info("exported to %s", path)
    log.info("%d rows are translated, %d failed", total, failed)
    return int(failed > 0 and not config.skip_unrecoverable)


def second_pass(spark: SparkSession, args: argparse.Namespace, backend: Backend, config: TranslateConfig, column: str) -> int:
    path, limits = args.output or output_name(config.target_locale), QaThresholds(**{f.name: getattr(args, f.name) for f in fields(QaThresholds)})
    if args.mode == "high-confidence-report":
        sure = passes.written(qa.sure_report(read(spark, args.report_file), limits, args.max_rows), "sure")
        tables.write_report(sure, args.high_confidence_report_file, args.rebuild_report, sure=True)
        if args.blank_flagged_translations:
            put((reports.blanked(read(spark, path), sure, column).drop("was_blanked"), path))
        return 0
    output = _named(reports.with_column(read(spark, path), column), args)
    decisions = _decisions(spark, args.decisions_file)
    if args.mode == "problematic":
        after, queue = passes.queue_pass(output, tables.read_strings(spark, args.problematic_file), backend, column, config, args.max_rows, args.every, _progress)
        put((_own(after, args), path), (queue, args.problematic_file))
    elif args.mode == "reevaluate":
        old = read(spark, args.report_file) if tables.exists(spark, args.report_file) and not args.rebuild_report else None
        after, report = passes.reevaluate(output, old, None if args.dry_run else backend, column, limits, config, args.max_rows, args.blank_flagged_translations, args.every, _progress)
        put((report, args.report_file), *([(_own(after, args), path)] if not args.dry_run or args.blank_flagged_translations else []))
    else:
        after, report = passes.rerun_report(output, read(spark, args.high_confidence_report_file), "high-confidence", backend, column, config, args.max_rows, decisions, every=args.every, flush=_progress)
        put((_own(after, args), path), (report, args.high_confidence_report_file))
    return 0


def selected(spark: SparkSession, args: argparse.Namespace, backend: Backend, config: TranslateConfig, column: str) -> int:
    path = args.output or output_name(config.target_locale, args.input)
    ids = tables.chosen_ids(spark, args.row_ids, args.row_ids_file)
    if ids.isEmpty():
        raise SystemExit("no row ids")
    old = read(spark, args.report_file) if tables.exists(spark, args.report_file) and not args.rebuild_report else None
    output = _named(reports.with_column(read(spark, path), column), args)
    after, report = passes.selected_pass(ids, _named(read(spark, args.input), args), output, old, backend, column, config, args.blank_on_start, args.force, _decisions(spark, args.decisions_file), args.every, _progress)
    put((_own(after, args), path), (report, args.report_file))
    for r in reports.action_summary(read(spark, args.report_file)).orderBy("action").collect():
        log.info("%s: %d", r["action"], r["n"])
    return 0


def _progress(done: DataFrame) -> None:
    log.info("answers: %s", reports.run_counters(done).first().asDict())


def _decisions(spark: SparkSession, path: str) -> DataFrame | None:
    """row_id and accepted from a review: y, yes, s and si accept; n, no and nothing reject."""
    if not path:
        return None
    word = F.lower(F.trim("accepted"))
    return read(spark, path).select("row_id", word.isin("y", "yes", "s", "si", "true").alias("accepted"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None, backend: Callable[[TranslateConfig], Backend] | None = None) -> int:
    """Runs a program; spark and backend are for callers that have their own."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s", datefmt="%H:%M:%S")
    config, column = _settings(args)
    session = spark or SparkSession.builder.appName("corpusloom").getOrCreate()
    url = (args.base_url or "http://localhost:11434").rstrip("/") + "/api/generate"
    model = backend(config) if backend else http_backend(url, config)
    return {"translate": translate, "second-pass": second_pass, "selected": selected}[args.program](session, args, model, config, column)


if __name__ == "__main__":
    sys.exit(main())
