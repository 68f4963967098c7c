"""Operator 8, a quality classifier with hierarchical empirical Bayes.

A logistic model of a few text features gives each document its own evidence. Mean evidence by host, and by path within the
host, is shrunk: a path toward its host, a host toward the corpus, the more the fewer documents it has. How strongly is
estimated from the corpus (method of moments). A document's score combines both as log odds, without its own share in its
site's posterior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import WORD, apart, cut, restored, small

#: The classifier is fitted on about so many labelled documents at most, drawn by hash.
SAMPLE = 4_000
#: Evidence is kept this far from 0 and 1, and prior strengths between these bounds.
CLIP, STRENGTHS = 1e-4, (2.0, 1000.0)
KEEP = 0.5


def features(text: Column) -> Column:
    """array<double>: shares of symbols, capitals and digits, of distinct words, of words like the one before, and log length."""
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    symbols = F.length(F.regexp_replace(text, r"""[\p{L}\p{N}_\s.,;:'"()-]+""", ""))
    return F.transform(
        F.array(F.struct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"), n.alias("n"), symbols.alias("s"), F.regexp_count(text, F.lit(r"\p{Lu}")).alias("u"), F.regexp_count(text, F.lit("[0-9]")).alias("d"))),
        lambda x: F.array(
            F.sqrt(x["s"] / x["n"]),
            F.sqrt(x["u"] / x["n"]),
            F.sqrt(x["d"] / x["n"]),
            F.size(F.array_distinct(x["w"])) / F.greatest(F.size(x["w"]), F.lit(1)),
            F.sqrt(F.size(F.filter(F.zip_with(x["w"], F.slice(x["w"], 2, 2147483647), lambda a, b: a == b), lambda same: same)) / F.greatest(F.size(x["w"]), F.lit(1))),
            F.log(x["n"]),
        ),
    )[0]


@dataclass(frozen=True)
class EvidenceModel:
    """Weights of standardised features; the bias is the first."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def probability(self, values: Column) -> Column:
        """Evidence of good quality from an array of features, within CLIP of 0 and 1."""
        terms = F.zip_with(values, F.array(*(F.lit(w / s) for w, s in zip(self.weights[1:], self.scale, strict=True))), lambda a, b: a * b)
        bias = self.weights[0] - sum(w * m / s for w, m, s in zip(self.weights[1:], self.mean, self.scale, strict=True))
        odds = F.aggregate(terms, F.lit(float(bias)), lambda a, b: a + b)
        return F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), 1 / (1 + F.exp(-odds))))


NEUTRAL = EvidenceModel((), (), (0.0,))


def fit_evidence(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> EvidenceModel:
    """Ridge logistic regression on about `sample` labelled documents at most. Without labels of both kinds, or without
    their documents, every document's evidence is neutral."""
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_label"))
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("_id", F.lit("quality")), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample)
    known_docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = known_docs.join(F.broadcast(chosen), F.col("doc") == F.col("_id")).select(features(F.col("text")).alias("x"), F.col("_label").alias("y")).limit(4 * sample).collect()
    y = np.array([r["y"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return NEUTRAL
    x = np.array([r["x"] for r in rows], float)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums of floats must not
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, ridge = np.zeros(z.shape[1]), 1e-2 * np.eye(z.shape[1]) * len(x) ** 0.5
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return EvidenceModel(tuple(map(float, mean)), tuple(map(float, scale)), tuple(float(v) for v in w.round(6)))


def _strength(groups: DataFrame, mean: float) -> float:
    """Prior strength by moments: little variance between groups means strong shrinkage."""
    r = groups.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.col("n") * (F.col("s") / F.col("n") - F.lit(mean)) ** 2)).first()
    if not r[0]:
        return STRENGTHS[1]
    noise = mean * (1 - mean)
    between = r[2] / r[0] - noise * r[1] / r[0]
    return min(STRENGTHS[1], max(STRENGTHS[0], noise / between - 1 if between > 0 else STRENGTHS[1]))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """Posteriors of paths: host, path, n, s (sum of evidence), k (strength of the host's prior) and prior (the host's
    posterior mean); and the corpus mean. evidence has host, path, p; both levels are grouped aggregates of it."""
    paths = cut(evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = total[1] / total[0] if total[0] else 0.5
    by_host, by_path = _strength(hosts, mean), _strength(paths, mean)
    posterior = hosts.select(F.col("host").alias("_host"), ((F.col("s") + by_host * mean) / (F.col("n") + by_host)).alias("prior"))
    return cut(paths.join(posterior, F.col("host") == F.col("_host")).drop("_host").withColumn("k", F.lit(by_path)), "sites"), mean


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def combined(evidence: Column, mean: float) -> Column:
    """Score from a document's evidence and its site's posterior without it."""
    site = (F.col("s") - evidence + F.col("k") * F.col("prior")) / (F.col("n") - 1 + F.col("k"))
    site = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), site))
    return 1 / (1 + F.exp(-(_odds(evidence) + _odds(site) - _odds(F.lit(min(1 - CLIP, max(CLIP, mean)))))))


def _sites(docs: DataFrame, source_col: str, path_cols: tuple[str, ...]) -> tuple[Column, Column]:
    host = F.coalesce(docs[source_col].cast("string"), F.lit(""))
    return host, F.concat_ws("/", host, *(F.coalesce(docs[c].cast("string"), F.lit("")) for c in path_cols))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path_cols: tuple[str, ...] = ("lang",)) -> DataFrame:
    """One row per row of docs: doc_id, host, path, evidence, score, keep (score of at least KEEP).

    The source is the host, source and language the path. Null sources and languages count as empty names, null texts as
    empty. Repeated rows count and are scored each; an empty table gives none; other columns are not read.
    """
    model = fit_evidence(docs, labels, id_col=id_col, text_col=text_col)
    host, path = _sites(docs, source_col, path_cols)
    rows = cut(docs.select(docs[id_col].alias("doc_id"), host.alias("host"), path.alias("path"), model.probability(features(docs[text_col])).alias("p")), "evidence")
    sites, mean = site_posteriors(rows)
    scored = rows.join(small(sites), ["host", "path"]).withColumn("score", combined(F.col("p"), mean))
    return scored.select("doc_id", "host", "path", F.col("p").alias("evidence"), "score", (F.col("score") >= KEEP).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path_cols: tuple[str, ...] = ("lang",)) -> DataFrame:
    """docs without the rows that score_quality would not keep, all columns kept; the same cases. Evidence is computed twice, as
    storing it means to store whole documents until nobody reads the result."""
    model = fit_evidence(docs, labels, id_col=id_col, text_col=text_col)
    own, text, source, *paths = apart(docs, text_col, source_col, *path_cols)
    host, path = _sites(own, source, tuple(paths))
    rows = own.withColumns({"host": host, "path": path, "p": model.probability(features(F.col(text)))})
    sites, mean = site_posteriors(rows.select("host", "path", "p"))
    joined = rows.join(small(sites), ["host", "path"])
    return restored(joined.where(combined(F.col("p"), mean) >= KEEP), docs)
