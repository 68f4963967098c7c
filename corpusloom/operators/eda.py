"""Exploration of labelled texts: working text, class counts, summaries, null audit, token frequencies."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.storage import written


def translation_column(names: list[str]) -> str | None:
    """The first known candidate among the names, or else the first statement_<ll>_<rr>."""
    known = [c for c in T.TRANSLATION_COLUMNS if c in names]
    return next(iter(known + [n for n in names if re.fullmatch(r"statement_[a-z]{2}_[a-z]{2}", n)]), None)


def usable_translation(c: Column) -> Column:
    """Not null, not blank, not the word nan."""
    return F.coalesce(c.isNotNull() & ~F.lower(T.strip(c)).isin("", "nan"), F.lit(False))


def working_text(df: DataFrame, original: str, translation: str | None) -> DataFrame:
    """statement_original, statement_translate, is_translated, statement_working and working_language added."""
    told = F.col(translation) if translation else F.lit(None).cast("string")
    out = df.withColumns({"statement_original": T.strip(T.text_or_empty(F.col(original))), "is_translated": usable_translation(told), "statement_translate": T.strip(T.text_or_empty(told))})
    return out.withColumns({"statement_working": F.when(F.col("is_translated"), F.col("statement_translate")).otherwise(F.col("statement_original")), "working_language": F.when(F.col("is_translated"), "es").otherwise("en")})


def valid_labels(df: DataFrame, label: str, labels) -> DataFrame:
    return df.withColumn(label, T.strip(F.col(label))).where(F.col(label).isin(*labels))


def class_distribution(df: DataFrame, label: str, labels) -> DataFrame:
    """place, label, n and share (percent, one decimal) of all labels of the list, also absent ones."""
    listed = df.sparkSession.createDataFrame([(k, x) for k, x in enumerate(labels)], "place int, label string")
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    joined = listed.join(counts, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())  # one row per label of the list
    return joined.select("place", "label", "n", F.when(total > 0, F.round(100 * F.col("n") / total, 1)).otherwise(F.lit(0.0)).alias("share"))


def text_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, translated rows and mean lengths of each class."""
    means = {f"mean_{c}_{k}": F.avg(f(F.col(f"statement_{s}"))) for k, s in (("en", "original"), ("es", "translate"), ("working", "working")) for c, f in (("chars", F.length), ("sentences", T.count_sentences))}
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_translated").cast("int")).alias("n_translated"), *(c.alias(k) for k, c in means.items()))


def quantiles(df: DataFrame, column: str, shares=(0.25, 0.5, 0.75)) -> list[float | None]:
    """Exact quantiles of a column, interpolated. Values are counted, and the counts summed in sorted slices, so no task has all
    of them; the driver gets the two values around each place."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    slices = written(counts.repartitionByRange(64, "v").withColumn("slice", F.spark_partition_id()), "values")
    sums = slices.groupBy("slice").agg(F.sum("n").alias("m"))
    before = sums.select("slice", F.coalesce(F.sum("m").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    upto = F.sum("n").over(Window.partitionBy("slice").orderBy("v")) + F.col("b")
    total = slices.agg(F.sum("n")).first()[0]
    if not total:
        return [None] * len(shares)
    at = [s * (total - 1) for s in shares]
    places = sorted({int(x) for x in at} | {min(int(x) + 1, total - 1) for x in at})
    ranked = slices.join(F.broadcast(before), "slice").withColumn("upto", upto)  # 64 rows
    rows = ranked.select("v", F.explode(F.filter(F.array(*map(F.lit, places)), lambda p: (p < F.col("upto")) & (p >= F.col("upto") - F.col("n")))).alias("p")).collect()
    found = {r["p"]: r["v"] for r in rows}
    return [found[int(x)] + (found[min(int(x) + 1, total - 1)] - found[int(x)]) * (x - int(x)) for x in at]


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, minimum, exact quartiles (interpolated), maximum."""
    df = written(df.select(*columns), "described")

    def stats(c: str) -> Column:
        q = [F.lit(x).cast("double") for x in quantiles(df, c)]
        return F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(c).cast("double").alias("max"))

    return df.agg(F.array(*map(stats, columns)).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def column_types(df: DataFrame) -> DataFrame:
    """column, dtype, n_rows, n_filled of every column."""
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema], "column string, dtype string")
    return types.join(null_audit(df).drop("n_null"), "column")


def label_counts(df: DataFrame, label: str, labels) -> DataFrame:
    """One row: rows before the filter on labels, of other labels, and left: n_before, n_invalid, n_after."""
    known = F.coalesce(T.strip(F.col(label)).isin(*labels), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(~known).alias("n_invalid"), F.count_if(known).alias("n_after"))


def filled_count(df: DataFrame, column: str) -> DataFrame:
    """One row: how many cells are not blank, translated_rows_total."""
    return df.agg(F.count_if(~T.is_blank(F.col(column))).alias("translated_rows_total"))


def heatmap(counts: DataFrame) -> DataFrame:
    """A confusion matrix as a chart needs it: actual, predicted, n and its share of the actual class."""
    total = F.sum("n").over(Window.partitionBy("actual"))  # one row per label
    return counts.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0)))


def null_audit(df: DataFrame) -> DataFrame:
    """column, n_rows, n_filled, n_null of every column, in one pass."""
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count(F.col(f"`{c}`")).alias("n_filled")) for c in df.columns))
    return df.agg(rows.alias("rows")).select(F.explode("rows").alias("r")).select("r.*", (F.col("r.n_rows") - F.col("r.n_filled")).alias("n_null"))


def sample_per_class(df: DataFrame, label: str, key: str, seed: str = "") -> DataFrame:
    """One row of each class, drawn by a hash of its key: the same in every run, and aggregated before the shuffle."""
    drawn = df.groupBy(label).agg(F.min_by(F.struct(*df.columns), F.struct(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), F.col(key))).alias("r"))
    return drawn.select("r.*")


def token_frequencies(df: DataFrame, label: str, tokens: Column, top: int) -> DataFrame:
    """The most frequent tokens of each class, ties by token: label, token, n, place."""
    counts = df.select(F.col(label).alias("label"), F.explode(tokens).alias("token")).groupBy("label", "token").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "token"))
    return counts.withColumn("place", place).where(F.col("place") <= top)


def distinct_in_order(df: DataFrame, column: str, position: str) -> DataFrame:
    """The values of a column and where each came first."""
    return df.groupBy(column).agg(F.min(position).alias("first_seen"))


def in_first_order(df: DataFrame, column: str, position: str) -> DataFrame:
    """The values of a column, each once, sorted by where it came first: the column, and place (that position)."""
    return distinct_in_order(df, column, position).withColumnRenamed("first_seen", "place").orderBy("place")


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """actual, predicted, n over the dense grid of the labels that occur on either side (a small list, times itself)."""
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.select(F.col("actual").alias("x")).union(counts.select("predicted")).distinct()
    packed = labels.agg(F.array_sort(F.collect_set("x")).alias("all"))
    grid = packed.select(F.explode("all").alias("actual"), "all").select("actual", F.explode("all").alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """label, precision, recall, f1, support of each class, and the rows accuracy, macro avg, weighted avg; 0 for 0 / 0."""
    m = confusion(df, actual, predicted)
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    rows = m.groupBy(F.col("actual").alias("label")).agg(F.sum(hit).alias("tp"), F.sum("n").alias("support"))
    columns = m.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("said"))
    each = rows.join(columns, "label").select("label", "tp", "support", safe(F.col("tp"), F.col("said")).alias("precision"), safe(F.col("tp"), F.col("support")).alias("recall"))
    each = each.withColumn("f1", safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    total = F.sum("support")
    whole = each.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *(safe(F.sum("tp"), total).alias(c) for c in ("precision", "recall", "f1")), total.alias("support")),
            F.struct(F.lit("macro avg").alias("label"), *(F.avg(c).alias(c) for c in ("precision", "recall", "f1")), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("label"), *(safe(F.sum(F.col(c) * F.col("support")), total).alias(c) for c in ("precision", "recall", "f1")), total.alias("support")),
        ).alias("rows")
    )
    return each.select("label", "precision", "recall", "f1", "support").unionByName(whole.select(F.explode("rows").alias("r")).select("r.*"))
