"""The passes over a translated table, as functions from tables to tables.

The answers of the model are written once and read from there, so that a row's text, state and place in the queue come from
one call. Long runs go in batches of rows: `flush` gets each batch's answers when they are there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import QaThresholds, TranslateConfig
from corpusloom.functions.text import is_blank
from corpusloom.operators import qa, reports
from corpusloom.operators.translate import Backend, translated, translated_in_chunks
from corpusloom.storage import written

Flush = Callable[[DataFrame], None]


def now() -> Column:
    """UTC, as text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _answers(todo: DataFrame, call: Callable[[DataFrame], DataFrame], every: int = 0, flush: Flush | None = None) -> DataFrame:
    """What call makes of todo, written; in batches of `every` rows in order of id if that is not 0."""
    if not every:
        done = written(call(todo), "answers")
        if flush:
            flush(done)
        return done
    batches = written(reports.batched(todo, every), "todo")
    parts = []
    for k in range(1, (batches.agg(F.max("batch_no")).first()[0] or 0) + 1):
        parts.append(written(call(batches.where(F.col("batch_no") == k).drop("batch_no")), "answers"))
        if flush:
            flush(parts[-1])
    return reduce(DataFrame.unionByName, parts) if parts else written(call(todo.limit(0)), "answers")


def first_pass(output: DataFrame, backend: Backend, column: str, config: TranslateConfig = TranslateConfig(), start_row: int = 0, max_batches: int = 0, every: int = 0, flush: Flush | None = None) -> tuple[DataFrame, DataFrame]:
    """The output with pending cells translated, those of the first max_batches batches only if that is not 0, and the problem
    queue of rows that failed."""
    todo = reports.pending(output, column, start_row)
    if max_batches:
        todo = reports.batched(todo, config.batch_size).where(F.col("batch_no") <= max_batches).drop("batch_no")
    done = _answers(todo, lambda rows: translated(rows, backend, config), every, flush)
    failed = todo.join(done.where("state <> 'success'").select("row_id", "state"), "row_id")
    return reports.written_back(output, done.where("state = 'success'"), column), reports.failed_rows(failed, F.col("state"), now())


def queue_pass(output: DataFrame, queue: DataFrame, backend: Backend, column: str, config: TranslateConfig = TranslateConfig(), most: int = 0, every: int = 0, flush: Flush | None = None) -> tuple[DataFrame, DataFrame]:
    """Translates queued rows in chunks, the first `most` by id only if that is not 0: the output, and the queue without what
    succeeded."""
    todo = reports.queue_with_output(queue, output, column)
    todo = todo.orderBy("row_id").limit(most) if most else todo
    done = _answers(todo, lambda rows: translated_in_chunks(rows, backend, config), every, flush).where("state = 'success'")
    return reports.written_back(output, done, column), reports.queue_without(queue, done)


def reevaluate(output: DataFrame, previous: DataFrame | None, backend: Backend | None, column: str, limits: QaThresholds = QaThresholds(), config: TranslateConfig = TranslateConfig(), most: int = 0, blank_flagged: bool = False, every: int = 0, flush: Flush | None = None) -> tuple[DataFrame, DataFrame]:
    """Scores the output and translates suspicious rows again, the worst `most` only if set: the output, and the full report.
    Without a backend (a dry run) nothing is translated. blank_flagged empties the cells of the report's open rows first."""
    report = qa.suspicious(output.withColumn("current_translation", F.col(column)), limits)
    if previous is not None:
        report = reports.with_previous(report, previous)
    report = written(report, "report")
    todo = qa.ranked(report.where(~reports.is_done(F.col("action"), "reevaluate")), most)
    if blank_flagged:
        output = reports.blanked(output, todo, column).drop("was_blanked")
    return (output, report) if backend is None else _rerun(output, report, todo, backend, column, config, None, every, flush)


def rerun_report(output: DataFrame, report: DataFrame, mode: str, backend: Backend, column: str, config: TranslateConfig = TranslateConfig(), most: int = 0, decisions: DataFrame | None = None, source_col: str = "source_text", label_col: str = "label", every: int = 0, flush: Flush | None = None) -> tuple[DataFrame, DataFrame]:
    """Translates the open rows of a report (modes high-confidence and selected), the first `most` by id only if set: the output,
    and the report.

    Source texts and labels that the report lacks come from the output. decisions (row_id, accepted) stand for a review: rows
    that it rejects are not written back.
    """
    known = reports.with_fallbacks(report, output, source_col, label_col)
    stuck = reports.terminal_state(F.col("row_id").cast("string"), F.col("_there"), F.col("source_text"))
    known = known.withColumn("action", F.when(reports.is_done(F.col("action"), mode), F.col("action")).otherwise(F.coalesce(stuck, F.col("action")))).drop("_there")
    open_ = ~reports.is_done(F.col("action"), mode) & ~F.startswith(F.col("action"), F.lit("missing_")) & (F.col("action") != "invalid_row_id")
    todo = known.where(open_)
    return _rerun(output, known, todo.orderBy("row_id").limit(most) if most else todo, backend, column, config, decisions, every, flush)


def selected_pass(ids: DataFrame, source: DataFrame, output: DataFrame, existing: DataFrame | None, backend: Backend, column: str, config: TranslateConfig = TranslateConfig(), blank_on_start: bool = False, force: bool = False, decisions: DataFrame | None = None, every: int = 0, flush: Flush | None = None) -> tuple[DataFrame, DataFrame]:
    """Translates chosen rows: their report, from source and output and an earlier one, and what rerun_report makes of it.

    Rows that are translated already count as done; force opens them again. blank_on_start empties the cells of chosen rows,
    which opens them too.
    """
    if blank_on_start:
        output = written(reports.blanked(output, ids, column).drop("was_blanked"), "output")
    report = reports.selected_report(ids.select("row_id"), source, output, column)
    if existing is not None:
        report = reports.merged_report(report, reports.only_selected(existing, ids)).drop("reused")
    if force or blank_on_start:
        report = report.withColumn("action", F.when((F.col("action") == "success") & (F.lit(force) | is_blank(F.col("current_translation"))), "pending").otherwise(F.col("action")))
    return rerun_report(output, report, "selected", backend, column, config, 0, decisions, every=every, flush=flush)


def _rerun(output: DataFrame, report: DataFrame, todo: DataFrame, backend: Backend, column: str, config: TranslateConfig, decisions: DataFrame | None, every: int, flush: Flush | None) -> tuple[DataFrame, DataFrame]:
    done = _answers(todo, lambda rows: translated_in_chunks(rows, backend, config), every, flush)
    marks = done.select("row_id", F.col("new_text").alias("_text"), F.col("state").alias("_state"))
    told = report.join(marks, "row_id", "left").withColumns({"action": F.coalesce("_state", "action"), "new_translation": F.coalesce("_text", "new_translation")}).drop("_text", "_state")
    good = done.where("state = 'success'")
    if decisions is not None:
        asked = decisions.join(good.select("row_id"), "row_id", "left_semi")
        told = reports.decided(told, asked)
        good = good.join(asked.where("NOT accepted"), "row_id", "left_anti")
    return reports.written_back(output, good, column), told
