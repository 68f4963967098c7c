"""Text classification: split, balance, TF-IDF features, four classifiers and their comparison, two of them of pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.feature import Binarizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import terms
from corpusloom.operators.bins import numbered
from corpusloom.operators.boosting import Boosting
from corpusloom.operators.tree import DecisionTree
from corpusloom.storage import spent

TEST_SHARE, VOCABULARY = 0.2, 50_000
#: Classes whose logistic regressions are fitted at once. Each keeps its own blocks of the training rows, in memory or on
#: disk, and adds to the driver's memory.
FITS = 1


def _hashed(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))


def _cutoffs(df: DataFrame, groups: list[str], key: str, seed: str, wanted: DataFrame) -> DataFrame:
    """groups and _last, hash and key of the row at place _want of each group in order of hash. wanted has groups and _want;
    groups that want no row are left out.

    Counts of hash prefixes tell in which prefix that row is; only ids of that prefix are ranked.
    """
    ids = df.select(*groups, F.struct(_hashed(key, seed).alias("h"), F.col(key).alias("k")).alias("_at")).withColumn("_p", F.left("_at.h", F.lit(3)))
    counts = ids.groupBy(*groups, "_p").agg(F.count(F.lit(1)).alias("_n"))  # 4096 prefixes of a group at most
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*groups).orderBy("_p")))
    edge = upto.join(F.broadcast(wanted.where("_want > 0")), groups) if groups else upto.crossJoin(F.broadcast(wanted.where("_want > 0")))  # one row of a group
    edge = edge.where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want"))).select(*groups, "_p", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_left"))
    ranked = ids.join(F.broadcast(edge), [*groups, "_p"]).withColumn("_place", F.row_number().over(Window.partitionBy(*groups, "_p").orderBy("_at")))
    return ranked.where("_place = _left").select(*groups, F.col("_at").alias("_last"))


def split_exactly(df: DataFrame, key: str, share: float = TEST_SHARE, seed: str = "") -> DataFrame:
    """df with in_test: the ceil(share * n) rows of smallest hash. Rows are compared with the last of these, and not sorted."""
    wanted = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(share)).alias("_want"))
    last = _cutoffs(df, [], key, seed, wanted).first()
    if last is None:
        return df.withColumn("in_test", F.lit(False))
    at = F.struct(_hashed(key, seed).alias("h"), F.col(key).alias("k"))
    return df.withColumn("in_test", at <= F.struct(F.lit(last["_last"]["h"]).alias("h"), F.lit(last["_last"]["k"]).alias("k")))


def balanced(df: DataFrame, label: str, key: str) -> DataFrame:
    """df with _copies: how often each row has to stand so that each class has as many as the largest. All rows of a class equally
    often, and the first by hash once more."""
    counts = df.groupBy(F.col(label)).agg(F.count(F.lit(1)).alias("_n"))
    sized = counts.withColumn("_top", F.max("_n").over(Window.partitionBy())).withColumn("_want", F.col("_top") % F.col("_n"))  # one row per class
    plan = sized.join(_cutoffs(df, [label], key, "", sized.select(label, "_want")), label, "left")
    more = F.coalesce(F.struct(_hashed(key, "").alias("h"), F.col(key).alias("k")) <= F.col("_last"), F.lit(False)).cast("int")
    return df.join(F.broadcast(plan), label).select(*df.columns, (F.floor(F.col("_top") / F.col("_n")).cast("int") + more).alias("_copies"))


def oversampled(df: DataFrame, label: str, key: str) -> DataFrame:
    """df with the rows of each class repeated as balanced() says."""
    return balanced(df, label, key).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*df.columns)


def oversample_plan(df: DataFrame, label: str) -> DataFrame:
    """label, n, target, added of each class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    target = F.max("n").over(Window.partitionBy())  # one row per class
    return counts.withColumn("target", target).withColumn("added", F.col("target") - F.col("n"))


def document_frequencies(df: DataFrame, text: str) -> DataFrame:
    """term, df, idf (smooth: ln((1 + n) / (1 + df)) + 1) of lower-cased terms of two word characters or more."""
    terms = df.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)))).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(rows)).select("term", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))  # one row


def classifiers(rows: int, key: str, rounds: int = 500) -> dict[str, object]:
    """The four classifiers with their settings, for the rows of balanced(), on all of which each is fitted; rounds is the number
    of boosting rounds."""
    common = {"featuresCol": "features", "labelCol": "y", "weightCol": "_copies"}
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=1.0 / (10.0 * max(rows, 1)), standardization=False, maxIter=50)
    return {
        "bernoulli_nb": Pipeline(stages=[Binarizer(threshold=0.0, inputCol="features", outputCol="_on"), NaiveBayes(modelType="bernoulli", smoothing=0.1, featuresCol="_on", labelCol="y", weightCol="_copies")]),
        "decision_tree": DecisionTree(key, copies="_copies"),
        "logistic_regression": OneVsRest(classifier=lasso, parallelism=FITS, **common),
        "gradient_boosting": Boosting(key, rounds, copies="_copies"),
    }


def evaluated(df: DataFrame, key: str, text: str, label: str, numeric: list[str], names: list[str], vocabulary: int = VOCABULARY, rounds: int = 500) -> DataFrame:
    """Predictions on the test rows: classifier, key, actual, predicted. Features and index are fitted on the training rows."""
    parts = split_exactly(df, key)
    train, test = parts.where("NOT in_test"), parts.where("in_test")
    index = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc", handleInvalid="skip").fit(train)
    known, idf = terms.vocabulary(train, text, vocabulary)
    ready = terms.vectors(index.transform(balanced(train, label, key)), text, numeric, known, idf, [key, "y", "_copies"], "ready")
    asked = terms.vectors(index.transform(test), text, numeric, known, idf, [key, label], "asked")
    rows = ready.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    models = classifiers(rows, key, rounds)
    made = numbered(ready, "_copies") if {"decision_tree", "gradient_boosting"} & set(names) else None
    fitted = {name: models[name].fit(ready, made) if made and name in ("decision_tree", "gradient_boosting") else models[name].fit(ready) for name in names}
    spent(ready, *([made.table] if made else []))
    names_of = F.array(*map(F.lit, index.labels))
    out = None
    for name in names:
        said = fitted[name].transform(asked).select(F.lit(name).alias("classifier"), key, F.col(label).alias("actual"), F.element_at(names_of, F.col("prediction").cast("int") + 1).alias("predicted"))
        out = said if out is None else out.unionByName(said)
    return out


def shape(vectors: DataFrame, column: str = "features") -> DataFrame:
    """Rows, columns and stored values of a table of vectors, as one row: n_rows, n_columns, n_stored."""
    array = F.size(vector_to_array(F.col(column)))
    stored = F.size(F.filter(vector_to_array(F.col(column)), lambda v: v != 0))
    return vectors.agg(F.count(F.lit(1)).alias("n_rows"), F.max(array).alias("n_columns"), F.sum(stored).alias("n_stored"))


def comparison(predictions: DataFrame) -> DataFrame:
    """Accuracy of each classifier, best first."""
    right = (F.col("actual") == F.col("predicted")).cast("int")
    return predictions.groupBy("classifier").agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("accuracy"), "classifier")
