"""Operator 10, language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed character n-grams. Each language has several centroids, made by clustering
its training vectors; a text gets the language of the centroid nearest by cosine. A text farther from it than nearly all
training texts of that language are from theirs is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import chunks, claim, cut, small
from corpusloom.shipping import ship

#: Lengths of the n-grams, hashed features, centroids of a language and rounds of clustering.
GRAMS, FEATURES, CENTROIDS, ROUNDS = (1, 2, 3), 1 << 13, 4, 8
#: The classifier is fitted on about this many documents of each language at most, drawn by hash, and on so many in all; on
#: about EACH of each language where that makes more.
SAMPLE, SAMPLE_IN_ALL, EACH = 400, 4_000, 8
#: Most bytes of centroids in a worker: about 8000 languages.
MODEL_BYTES = 1 << 30
#: The training texts' share that may lie beyond the rejection distance.
REJECTED = 0.005
_STEP = 100_000
_SIGNS = re.compile(r"[\x00-\x40\x5b-\x60\x7b-\x7f\s]+")


def vector(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of the lower-cased text; single blanks stand for white space, and for the signs and digits of
    ASCII, which tell styles apart and not languages."""
    points = np.frombuffer((" " + _SIGNS.sub(" ", text.lower()).strip() + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    counts = np.zeros(FEATURES)
    for start in range(0, len(points), _STEP):
        part = points[start : start + _STEP + max(GRAMS) - 1]
        for n in GRAMS:
            stop = min(len(part) - n + 1, _STEP)
            if stop > 0:
                key = np.full(stop, n, np.uint64)
                for k in range(n):
                    key = key * np.uint64(0x9E3779B97F4A7C15) + part[k : k + stop]
                counts += np.bincount(((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % FEATURES, minlength=FEATURES)
    return counts


def scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic TF times IDF, of length 1."""
    out = np.log1p(counts) * idf
    norm = np.linalg.norm(out, axis=-1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """The places and values of what is not 0."""
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes()


def unpacked(places: bytes, values: bytes) -> np.ndarray:
    out = np.zeros(FEATURES, np.float32)
    out[np.frombuffer(places, "<u2")] = np.frombuffer(values, "<f4")
    return out


def cluster(own: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids of one language's vectors by spherical k-means, started from spread-out members, and the distance from their
    centroid that all but REJECTED of the vectors keep; all deterministic."""
    chosen = [int(np.argmax(own @ own.sum(axis=0)))]
    while len(chosen) < min(CENTROIDS, len(own)):
        chosen.append(int(np.argmin((own @ own[chosen].T).max(axis=1))))
    centres = own[chosen]
    for _ in range(ROUNDS):
        nearest = np.argmax(own @ centres.T, axis=1)
        sums = np.array([own[nearest == k].sum(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres.astype(np.float32), float(np.quantile(1 - (own @ centres.T).max(axis=1), 1 - REJECTED))


class CentroidModel:
    """IDF, centroids with their languages, and each language's rejection distance."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], limits: dict[str, float]) -> None:
        self.idf, self.centroids, self.languages, self.limits = idf, centroids, languages, limits

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the text is too far from it; und, 0, True without letters."""
        if not self.languages or not _letters(text):
            return "und", 0.0, True
        cosines = self.centroids @ scaled(vector(text), self.idf).astype(np.float32)
        best = int(np.argmax(cosines))
        score = min(1.0, max(0.0, float(cosines[best])))
        return self.languages[best], score, 1 - score > self.limits[self.languages[best]]


def held_out(id_col: str):
    """Documents that are never learned from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letters(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("language")
    for batch in chunks(batches, "text"):
        rows = [(lang, h, *packed(vector(text))) for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text")), strict=True) if _letters(text)]
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
        yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["lang", "h", "places", "counts"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and document frequencies of one task's vectors; place -1 has the number of rows."""
    total, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for places in batch.column("places").to_pylist():
            total[np.frombuffer(places, "<u2")] += 1
    yield pa.record_batch([pa.array([-1, *range(FEATURES)], pa.int32()), pa.array([rows, *total.tolist()], pa.int64())], names=["place", "df"])


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> CentroidModel:
    """Fits the model on about `sample` documents of each language at most and SAMPLE_IN_ALL in all, or EACH of each language
    where that is more; drawn by a hash of id and text from those that are not held out. Equal rows are learned from once.

    Language and id choose the training rows only. Rows with a null language or no letter are not learned from. Every other
    language is learned: of one from which nothing would be drawn, the row of smallest hash is. Vectors are made and clustered
    in the workers, a language at a time; the driver gets document frequencies of the FEATURES and the centroids, and raises a
    ValueError if these have more than MODEL_BYTES.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit("lang")).alias("h"), held_out(id_col).alias("out"))
    rows = rows.where("NOT out AND lang IS NOT NULL").where(F.coalesce("text", F.lit("")).rlike(r"\p{L}")).drop("out")
    shares = cut(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")), "languages")
    languages = shares.count()
    if not languages:
        return CentroidModel(np.zeros(FEATURES), np.zeros((0, FEATURES), np.float32), [], {})
    most = min(sample, max(EACH, SAMPLE_IN_ALL / languages))
    limits = shares.select("lang", "least", F.floor(F.least(F.lit(1.0), F.lit(float(most)) / F.col("n")) * (1 << 30)).alias("limit"))
    drawn = rows.join(small(limits), "lang").where((F.pmod("h", F.lit(1 << 30)) < F.col("limit")) | (F.col("h") == F.col("least")))
    counted = drawn.select("lang", "h", "text").mapInArrow(_count, "lang string, h long, places binary, counts binary")
    vectors = cut(counted.groupBy("lang", "h").agg(F.first("places").alias("places"), F.first("counts").alias("counts")), "vectors")
    seen = {r["place"]: r["df"] for r in vectors.select("places").mapInArrow(_frequencies, "place int, df long").groupBy("place").agg(F.sum("df").alias("df")).collect()}
    n = seen.pop(-1)
    idf = np.log((1 + n) / (1 + np.array([seen[k] for k in range(FEATURES)], float))) + 1

    def of_language(key, group):
        group = group.sort_values("h")
        own = scaled(np.array([unpacked(p, c) for p, c in zip(group["places"], group["counts"], strict=True)]), idf)
        centres, limit = cluster(own)
        made = [(key[0], k, *packed(c), limit) for k, c in enumerate(centres)]
        return pd.DataFrame(made, columns=["lang", "k", "places", "weights", "limit"])

    made = cut(vectors.groupBy("lang").applyInPandas(of_language, "lang string, k int, places binary, weights binary, limit double"), "centroids")
    if made.count() * FEATURES * 4 > MODEL_BYTES:
        raise ValueError("too many languages for a model in every worker")
    found = made.orderBy("lang", "k").collect()
    return CentroidModel(idf, np.array([unpacked(r["places"], r["weights"]) for r in found]), [r["lang"] for r in found], {r["lang"]: r["limit"] for r in found})


def predict_languages(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score (cosine), rejected. Whole texts are used.

    A text that is null or has no letter is `und` with score 0. A rejected text keeps its nearest language. A model of no
    rows knows no language: all is und. Repeated rows give repeated rows, an empty table an empty one.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        for batch in chunks(batches, "text"):
            out = [sent.value.predict(t) for t in batch.column("text").to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return read.mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
