"""Tables with state: alignment, pending work, problem queue, reports and write-back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import is_blank, strip, text_or_empty
from corpusloom.storage import written

COMPLETED = ("success", "rejected_blank", "missing_row")
#: Further states that a mode does not run again.
SKIPPED = {"reevaluate": ("empty_retry", "failed:"), "selected": ("failed:",), "high-confidence": ()}
QUEUE = ("row_id", "label", "text_length", "reason", "source_text", "logged_at")


def parsed_id(c: Column) -> Column:
    """A whole number, or null."""
    return F.trim(c.cast("string")).try_cast("bigint")


def clean_names(df: DataFrame) -> DataFrame:
    """Trimmed column names, the first of equal ones kept."""
    names = [n.strip() for n in df.columns]
    first = [k for k, n in enumerate(names) if n not in names[:k]]
    return df.toDF(*(f"_{k}" for k in range(len(names)))).select(*(F.col(f"_{k}").alias(names[k]) for k in first))


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*(text_or_empty(F.col(f"`{c}`")).alias(c) for c in df.columns))


def with_column(df: DataFrame, name: str) -> DataFrame:
    """df with an empty text column of this name if it has none."""
    return df if name in df.columns else df.withColumn(name, F.lit(""))


def renamed_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """old as new; if both are there, new where it is not blank."""
    if old not in df.columns:
        return df
    if new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df.withColumn(new, F.when(~is_blank(F.col(new)), F.col(new)).otherwise(F.col(old))).drop(old)


def any_null_dropped(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def alignment_problems(source: DataFrame, output: DataFrame) -> DataFrame:
    """kind and n: duplicate ids of the output, source ids it lacks, and a difference in rows."""
    src, out = source.where("row_id IS NOT NULL"), output.where("row_id IS NOT NULL")
    twice = out.groupBy("row_id").count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("duplicate"))
    lacking = src.join(out, "row_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("missing"))
    rows = source.agg(F.count(F.lit(1)).alias("a")).crossJoin(output.agg(F.count(F.lit(1)).alias("b"))).select(F.abs(F.col("a") - F.col("b")).alias("n"), F.lit("row_count").alias("kind"))  # two single rows
    return reduce(DataFrame.unionByName, [twice, lacking, rows]).select("kind", "n")


def aligned(source: DataFrame, output: DataFrame, column: str, check: bool = True) -> DataFrame:
    """source with the output's translation by id; rows without an id keep an empty cell. Raises on alignment_problems."""
    if check:
        wrong = {r["kind"]: r["n"] for r in alignment_problems(source, output).where("n > 0").collect()}
        if wrong:
            raise ValueError(f"the tables do not align: {wrong}")
    return source.join(output.select("row_id", text_or_empty(F.col(column)).alias(column)), "row_id", "left").withColumn(column, F.coalesce(column, F.lit("")))


def aligned_by_position(source: DataFrame, output: DataFrame, column: str, position: str = "position") -> DataFrame:
    """The same by position, for tables without ids."""
    return source.join(output.select(position, column), position, "left").withColumn(column, text_or_empty(F.col(column)))


def last_by_id(df: DataFrame, position: str) -> DataFrame:
    """One row per parsable id, the last by position."""
    rows = df.where("row_id IS NOT NULL").groupBy("row_id").agg(F.max_by(F.struct(*df.columns), position).alias("r"))
    return rows.select("r.*")


def pending(df: DataFrame, column: str, start_row: int = 0) -> DataFrame:
    return df.where((F.col("row_id") >= start_row) & is_blank(F.col(column)))


def numbered(df: DataFrame, order: str, name: str, slices: int = 64) -> DataFrame:
    """df with its place, from 0 on, in order, under `name`.

    Rows are numbered in range-partitioned slices whose counts are summed, so that no task sorts the whole table. The slices are
    written first: their bounds come from samples, and would differ between the counts and the places.
    """
    dealt = written(df.repartitionByRange(slices, order).withColumn("_slice", F.spark_partition_id()), "slices")
    counts = dealt.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_slice", F.coalesce(F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(order)) - 1 + F.col("_before")
    return dealt.join(F.broadcast(before), "_slice").withColumn(name, place).drop("_slice", "_before")  # `slices` rows at most


def batched(df: DataFrame, size: int, order: str = "row_id", slices: int = 64) -> DataFrame:
    """df with batch_no: numbers from 1 of runs of `size` rows in order."""
    return numbered(df, order, "_place", slices).withColumn("batch_no", (F.floor(F.col("_place") / size) + 1).cast("bigint")).drop("_place")


def batch_bounds(batches: DataFrame) -> DataFrame:
    return batches.groupBy("batch_no").agg(F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"), F.count(F.lit(1)).alias("n"))


def failed_rows(df: DataFrame, reason: Column, logged_at: Column) -> DataFrame:
    return df.select("row_id", "label", F.length(text_or_empty(F.col("source_text"))).alias("text_length"), reason.alias("reason"), "source_text", logged_at.alias("logged_at"))


def queue_upsert(queue: DataFrame, new: DataFrame) -> DataFrame:
    """The queue with new rows in place of those of the same id, sorted; rows without a parsable id go."""
    both = queue.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1))).withColumn("row_id", parsed_id(F.col("row_id"))).where("row_id IS NOT NULL")
    names = [c for c in both.columns if c not in ("row_id", "_age")]
    return both.groupBy("row_id").agg(F.max_by(F.struct(*names), F.struct("_age", *names)).alias("r")).select("row_id", "r.*").orderBy("row_id")


def queue_without(queue: DataFrame, resolved: DataFrame) -> DataFrame:
    """The queue without resolved ids; rows without a parsable id stay."""
    return queue.withColumn("_id", parsed_id(F.col("row_id"))).join(resolved.select(F.col("row_id").alias("_id")).distinct(), "_id", "left_anti").drop("_id")


def queue_with_output(queue: DataFrame, output: DataFrame, column: str) -> DataFrame:
    """Queue rows whose output cell is still blank, with the output's other columns."""
    more = [c for c in output.columns if c not in queue.columns or c == column]
    known = queue.drop(column).withColumn("row_id", parsed_id(F.col("row_id")))
    return known.join(output.select("row_id", *more), "row_id").where(is_blank(F.col(column)))


def normal_action(c: Column) -> Column:
    action = strip(text_or_empty(c))
    return F.when((action == "") | (action == "flagged"), "pending").when(action == "retranslated", "success").otherwise(action)


def is_done(c: Column, mode: str) -> Column:
    """Whether a mode leaves rows in this state alone."""
    action, done = normal_action(c), normal_action(c).isin(*COMPLETED)
    for state in SKIPPED[mode]:
        done = done | (F.startswith(action, F.lit(state)) if state.endswith(":") else action == state)
    return done


def action_summary(report: DataFrame) -> DataFrame:
    return report.groupBy(normal_action(F.col("action")).alias("action")).agg(F.count(F.lit(1)).alias("n"))


def with_previous(report: DataFrame, previous: DataFrame) -> DataFrame:
    """A new suspicious report with the state and the new translations of an earlier one."""
    old = previous.select("row_id", F.col("new_translation").alias("_new"), F.col("action").alias("_action"))
    joined = report.join(old, "row_id", "left")
    return joined.withColumns({"new_translation": text_or_empty(F.col("_new")), "action": normal_action(F.coalesce("_action", F.lit("pending")))}).drop("_new", "_action")


def selected_report(ids: DataFrame, source: DataFrame, output: DataFrame, column: str) -> DataFrame:
    """Report of chosen ids: missing_row if either table lacks one, success if it is translated, else pending."""
    joined = ids.join(source.select("row_id", "label", "source_text", F.lit(True).alias("_s")), "row_id", "left").join(output.select("row_id", F.col(column).alias("current_translation"), F.lit(True).alias("_o")), "row_id", "left")
    state = F.when(F.col("_s").isNull() | F.col("_o").isNull(), "missing_row").when(~is_blank(F.col("current_translation")), "success").otherwise("pending")
    return joined.select("row_id", *(text_or_empty(F.col(c)).alias(c) for c in ("label", "source_text", "current_translation")), F.lit("").alias("new_translation"), state.alias("action"))


def merged_report(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """A fresh report that keeps an earlier one's action and new translation; reused tells which rows were known."""
    old = existing.select("row_id", F.col("new_translation").alias("_new"), F.col("action").alias("_action"), F.lit(True).alias("_known"))
    joined = fresh.join(old, "row_id", "left")
    keep = {"new_translation": F.coalesce("_new", "new_translation"), "action": F.when(F.col("_known"), normal_action(F.col("_action"))).otherwise(F.col("action")), "reused": F.coalesce("_known", F.lit(False))}
    return joined.withColumns(keep).drop("_new", "_action", "_known")


def reuse_counts(merged: DataFrame) -> DataFrame:
    """How many rows of merged_report() an earlier report had, and how many are new: reused, added."""
    return merged.agg(F.count_if("reused").alias("reused"), F.count_if(~F.col("reused")).alias("added"))


def only_selected(report: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a report whose id is chosen."""
    return report.join(ids.select("row_id"), "row_id", "left_semi")


def with_fallbacks(report: DataFrame, output: DataFrame, source_col: str, label_col: str) -> DataFrame:
    """A report whose blank source texts and labels are taken from the output; _there tells whether the output has the row."""
    known = output.select("row_id", F.col(source_col).alias("_source"), F.col(label_col).alias("_label"), F.lit(True).alias("_there"))
    joined = report.join(known, "row_id", "left")
    own = {"source_text": F.when(~is_blank(F.col("source_text")), F.col("source_text")).otherwise(text_or_empty(F.col("_source")))}
    if "label" in report.columns:
        own["label"] = F.when(~is_blank(F.col("label")), F.col("label")).otherwise(text_or_empty(F.col("_label")))
    return joined.withColumns(own).drop("_source", "_label")


def run_counters(done: DataFrame) -> DataFrame:
    """One row of a run's counters: updated, empty, failed, total."""
    state = F.col("state")
    return done.agg(F.count_if(state == "success").alias("updated"), F.count_if(state == "empty_retry").alias("empty"), F.count_if(F.startswith(state, F.lit("failed:"))).alias("failed"), F.count(F.lit(1)).alias("total"))


def written_back(output: DataFrame, results: DataFrame, column: str) -> DataFrame:
    """The output with new texts by id."""
    new = results.select("row_id", F.col("new_text").alias("_new"))
    return output.join(new, "row_id", "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def blanked(output: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The output with the cells of these ids emptied; was_blanked tells where there was something."""
    marked = output.join(ids.select("row_id", F.lit(True).alias("_hit")).distinct(), "row_id", "left")
    hit = F.coalesce("_hit", F.lit(False)) & ~is_blank(F.col(column))
    return marked.withColumns({"was_blanked": hit, column: F.when(hit, "").otherwise(F.col(column))}).drop("_hit")


def terminal_state(row_id: Column, in_output: Column, source_text: Column) -> Column:
    """Why a report row cannot be run, or null."""
    return (
        F.when(is_blank(row_id), "missing_row_id").when(parsed_id(row_id).isNull(), "invalid_row_id").when(~F.coalesce(in_output, F.lit(False)), "missing_row").when(is_blank(source_text), "missing_source_text")
    )


def decided(report: DataFrame, decisions: DataFrame) -> DataFrame:
    """Accepts or rejects new translations: accepted rows are success, rejected ones rejected_blank with no text."""
    joined = report.join(decisions.select("row_id", F.col("accepted").alias("_ok")), "row_id", "left")
    action = F.when(F.col("_ok"), "success").when(~F.col("_ok"), "rejected_blank").otherwise(F.col("action"))
    return joined.withColumns({"action": action, "new_translation": F.when(~F.coalesce("_ok", F.lit(True)), "").otherwise(F.col("new_translation"))}).drop("_ok")


def response_problem(expected: Column, ids: Column, texts: Column) -> Column:
    """Why a response (arrays of ids, null if not whole numbers, and texts) does not fit its request, or null."""
    cells = F.arrays_zip(ids.alias("i"), texts.alias("t"))
    first = lambda bad, name: F.when(F.exists(cells, bad), name)
    return (
        F.coalesce(
            first(lambda x: x["i"].isNull(), "bad_id"), first(lambda x: is_blank(x["t"]), "blank_text"), F.when(F.size(F.array_except(ids, expected)) > 0, "unexpected_id"),
            F.when(F.size(F.array_distinct(ids)) < F.size(ids), "duplicate_id"), F.when(F.size(F.array_except(expected, ids)) > 0, "omitted_id"),
        )
    )


def ids_in_text(c: Column) -> Column:
    """All whole numbers of a text, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), lambda x: x.try_cast("bigint")))
