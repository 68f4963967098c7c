"""TF-IDF vectors of words and pairs of words: counted by task in numbers, so that only distinct terms become text and shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import RegexTokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from corpusloom.shipping import ship
from corpusloom.storage import spent, written

#: Words that are counted at once (a longer text at once, too), and distinct terms that a task holds before it passes them on.
WORDS, HELD = 500_000, 2_000_000


def _words(df: DataFrame, text: str) -> DataFrame:
    """df with _w, the words of text; null is empty."""
    words = RegexTokenizer(inputCol="_t", outputCol="_w", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=2, toLowercase=True)
    return words.transform(df.withColumn("_t", F.coalesce(text, F.lit("")))).drop("_t")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.DictionaryArray]]:
    """Some rows of batch after each other, with the row of each of their words, and these words."""
    upto = batch.column("_w").offsets.to_numpy().astype(np.int64)
    start = 0
    while start < batch.num_rows:
        end = max(int(np.searchsorted(upto, upto[start] + WORDS, side="right")) - 1, start + 1)
        part = batch.slice(start, end - start)
        words = part.column("_w").flatten().dictionary_encode()
        yield part, np.repeat(np.arange(end - start), np.diff(upto[start : end + 1])), words
        start = end


def _terms(row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of words and of pairs, those with a negative word left out; rows ascend within the words and within the pairs."""
    pair = (row[1:] == row[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
    key = np.concatenate([word[word >= 0], ((word[:-1] + 1 << 32) | word[1:])[pair]])
    return np.concatenate([row[word >= 0], row[1:][pair]]), key


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    key, n, df = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    return key[order][starts], np.add.reduceat(n[order], starts), np.add.reduceat(df[order], starts)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, n (times it occurs) and df (rows that have it); a term may come several times."""
    known: dict[str, int] = {}
    held, size = [], 0

    def told() -> pa.RecordBatch:
        key, n, df = _merged(held)
        words, space = pa.array(list(known), pa.large_string()), pa.scalar(" ", pa.large_string())
        single = key < 1 << 32  # these come first
        pairs = key[~single]
        names = [words.take(pa.array(key[single])), pc.binary_join_element_wise(words.take(pa.array((pairs >> 32) - 1)), words.take(pa.array(pairs & 0xFFFFFFFF)), space)]
        return pa.record_batch([pa.concat_arrays([x.cast(pa.string()) for x in names]), pa.array(n), pa.array(df)], names=["term", "n", "df"])

    for batch in batches:
        for _, row, words in _slices(batch):
            if not len(row):
                continue
            ids = np.array([known.setdefault(w, len(known)) for w in words.dictionary.to_pylist()], np.int64)
            row, key = _terms(row, ids[words.indices.to_numpy()])
            order = np.argsort(key, kind="stable")
            key, row = key[order], row[order]
            new = np.diff(key, prepend=-1) != 0
            starts = np.flatnonzero(new)
            held.append((key[starts], np.diff(starts, append=len(key)), np.add.reduceat((new | (np.diff(row, prepend=-1) != 0)).astype(np.int64), starts)))
            size += len(starts)
            if size > HELD:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield told()
                    known, held, size = {}, [], 0
    if held:
        yield told()


def vocabulary(train: DataFrame, text: str, size: int) -> tuple[list[str], np.ndarray]:
    """The commonest terms, of equal ones the first by code point, and their smooth IDF: ln((1 + n) / (1 + df)) + 1."""
    ship(train.sparkSession)
    counts = _words(train, text).select("_w").mapInArrow(counted, "term string, n long, df long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    top = written(counts.orderBy(F.desc("n"), "term").limit(size), "vocabulary")  # collected at once, each partition would send so many to the driver
    known = sorted(top.collect(), key=lambda r: (-r["n"], r["term"]))  # the vocabulary
    spent(top)
    return [r["term"] for r in known], np.log((train.count() + 1) / (np.array([r["df"] for r in known], float) + 1)) + 1


def vectors(df: DataFrame, text: str, numeric: list[str], known: list[str], idf: np.ndarray, kept: list[str], label: str) -> DataFrame:
    """kept and features, written: TF-IDF of the known terms at unit length, then the numeric columns as they are."""
    ship(df.sparkSession)
    number: dict[str, int] = {}
    keys = np.empty(len(known), np.int64)
    for k, term in enumerate(known):
        words = [number.setdefault(w, len(number)) for w in term.split(" ")]
        keys[k] = words[0] if len(words) == 1 else words[0] + 1 << 32 | words[1]
    column = np.argsort(keys)
    keys, size = keys[column], len(known) + len(numeric)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, row, words in _slices(batch):
                ids = np.array([number.get(w, -1) for w in words.dictionary.to_pylist()], np.int64)
                row, key = _terms(row, ids[words.indices.to_numpy()] if len(row) else np.empty(0, np.int64))
                place = np.searchsorted(keys, key)
                there = place < len(keys)
                there[there] = keys[place[there]] == key[there]
                cell, n = np.unique(row[there] * size + column[place[there]], return_counts=True)
                row = cell // max(size, 1)
                value = n * idf[cell % max(size, 1)]
                value /= np.sqrt(np.bincount(row, weights=value**2, minlength=part.num_rows))[row]
                for k, c in enumerate(numeric):
                    if part.column(c).null_count:
                        raise ValueError(f"{c} has nulls")
                    x = part.column(c).to_numpy(zero_copy_only=False).astype(float)
                    cell, value = np.concatenate([cell, np.flatnonzero(x) * size + len(known) + k]), np.concatenate([value, x[x != 0]])
                order = np.argsort(cell, kind="stable")
                cell, value = cell[order], value[order]
                offsets = pa.array(np.searchsorted(cell, np.arange(part.num_rows + 1) * size).astype(np.int32))
                fields = [pa.array(np.zeros(part.num_rows, np.int8)), pa.array(np.full(part.num_rows, size, np.int32)), pa.ListArray.from_arrays(offsets, pa.array((cell % max(size, 1)).astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(value))]
                yield pa.record_batch([*(part.column(c) for c in kept), pa.StructArray.from_arrays(fields, names=["type", "size", "indices", "values"])], names=[*kept, "features"])

    rows = _words(df, text).select(*dict.fromkeys([*kept, *numeric, "_w"]))
    plain = StructType([*(rows.schema[c] for c in kept), StructField("features", VectorUDT.sqlType())])
    table = written(rows.mapInArrow(made, plain), label)
    out = df.sparkSession.read.schema(StructType([*plain.fields[:-1], StructField("features", VectorUDT())])).parquet(table.cut_path)
    out.cut_path = table.cut_path
    return out
