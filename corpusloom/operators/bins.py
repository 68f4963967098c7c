"""Bins of the values of sparse rows, with bounds from all rows: trees are grown over these."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.shipping import ship
from corpusloom.storage import unshuffled, written

#: Bins of a feature.
BINS = 32


def flat(vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of what vectors (structs of pyspark.ml) store, in order of row, without zeros."""
    rows, features, values = [], [], []
    for k, v in enumerate(vectors):
        x = np.asarray(v["values"], float)
        at = np.arange(len(x)) if v["indices"] is None else np.asarray(v["indices"])
        rows.append(np.full(len(x), k))
        features.append(at)
        values.append(x)
    r, f, x = (np.concatenate([np.empty(0, t), *part]).astype(t) for part, t in ((rows, np.int64), (features, np.int64), (values, float)))
    return r[x != 0], f[x != 0], x[x != 0]


def stored(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """flat() of an Arrow column of vectors, without a Python object for each row where all are sparse."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    indices, values = column.field("indices"), column.field("values")
    if column.null_count or indices.null_count or column.offset:
        return flat(column.to_pylist())
    lengths = np.diff(indices.offsets.to_numpy())
    r, f, x = np.repeat(np.arange(len(column)), lengths), indices.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy()
    return r[x != 0], f[x != 0], x[x != 0]


@dataclass
class Bins:
    """Bounds of each feature's bins, ascending and with 0 among them: a bin holds values up to its bound, the last all others.
    Bins are numbered through; starts has the first of each feature and the number of all, zero the bin of value 0."""

    bounds: np.ndarray
    starts: np.ndarray
    zero: np.ndarray

    @classmethod
    def of(cls, feature: np.ndarray, value: np.ndarray, features: int, copies: np.ndarray | None = None) -> Bins:
        """Bounds after each part of a feature's ascending values, each value as often as copies says."""
        order = np.lexsort((value, feature))
        f, x = feature[order], value[order]
        weight = np.ones(len(f), np.int64) if copies is None else copies[order]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(weight)])
        first, after = np.searchsorted(f, np.arange(features)), np.searchsorted(f, np.arange(features), side="right")
        count, before = (upto[after] - upto[first])[f], upto[first][f]
        new = np.ones(len(f), bool)  # equal values make one run
        new[1:] = (f[1:] != f[:-1]) | (x[1:] != x[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(f))
        begin, end, count, before = upto[at], upto[ends], count[at], before[at]
        last = (end - before) * (BINS - 1) // count > (begin - before) * (BINS - 1) // count
        f, x = np.concatenate([f[at][last], np.arange(features)]), np.concatenate([x[at][last], np.zeros(features)])
        order = np.lexsort((x, f))
        f, x = f[order], x[order]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (x[1:] != x[:-1])
        f, x = f[new], x[new]
        starts = np.searchsorted(f, np.arange(features + 1)) + np.arange(features + 1)
        at_zero = np.flatnonzero(x == 0)
        return cls(x, starts, at_zero + f[at_zero])

    def number(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The bin of each value."""
        low = self.starts[feature] - feature  # a feature has a bound less than bins
        high = self.starts[feature + 1] - feature - 1
        end = high.copy()
        while (low < high).any():
            mid = np.minimum((low + high) // 2, len(self.bounds) - 1)
            more = (low < high) & (self.bounds[mid] < value)
            low, high = np.where(more, mid + 1, low), np.where(more | (low >= high), high, mid)
        return np.minimum(low, end) + feature

    def bound(self, number: int) -> float:
        """The largest value of a bin that is not its feature's last."""
        return float(self.bounds[number - (np.searchsorted(self.starts, number, side="right") - 1)])


def bounded(ready: DataFrame, copies: str | None = None) -> Bins:
    """Bins of the features of all rows of ready. The values are dealt out by feature, and only bounds go to the driver."""
    spark = ready.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = stored(batch.column("features"))
            n = batch.column("copies").to_numpy().astype(np.int64)[row]
            column = batch.column("features")
            width = max([int(feature.max()) + 1 if len(feature) else 0, *(s for s in column.field("size").to_pylist() if s is not None), *np.diff(column.field("values").offsets.to_numpy()).tolist()])
            order = np.lexsort((value, feature, feature % shares))
            feature, value, n = feature[order], value[order], n[order]
            cuts = np.searchsorted(feature % shares, np.arange(shares + 1))
            parts = [(s, width, np.diff(feature[i:j], prepend=0).astype(np.int32).tobytes(), value[i:j].tobytes(), n[i:j].astype(np.int32).tobytes()) for s in range(shares) if (i := cuts[s]) < (j := cuts[s + 1]) or not s]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array([p[k] for p in parts], t) for k, t in enumerate(kinds)], names=["share", "width", "feature", "value", "n"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [r for b in batches for r in b.to_pylist()]
        for s in sorted({p["share"] for p in parts}):
            mine = [p for p in parts if p["share"] == s]
            feature = np.concatenate([np.cumsum(np.frombuffer(p["feature"], np.int32), dtype=np.int64) for p in mine])
            value, n = np.concatenate([np.frombuffer(p["value"]) for p in mine]), np.concatenate([np.frombuffer(p["n"], np.int32) for p in mine]).astype(np.int64)
            names, place = np.unique(feature, return_inverse=True)
            found = Bins.of(place, value, len(names), n)
            sizes = np.diff(found.starts) - 1
            yield pa.record_batch([pa.array([max(p["width"] for p in mine)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (names, sizes, found.bounds))], names=["width", "names", "sizes", "bounds"])

    rows = ready.select("features", (F.col(copies) if copies else F.lit(1)).cast("int").alias("copies"))
    with unshuffled(spark):
        parts = rows.mapInArrow(dealt, "share int, width int, feature binary, value binary, n binary").repartition(shares, "share")
        found = parts.mapInArrow(merged, "width int, names binary, sizes binary, bounds binary").collect()  # BINS of a feature at most
    width = max((r["width"] for r in found), default=0)
    feature, bound = [np.arange(width)], [np.zeros(width)]  # features without values have the bound 0 only
    for r in found:
        feature.append(np.repeat(np.frombuffer(r["names"], np.int64), np.frombuffer(r["sizes"], np.int64)))
        bound.append(np.frombuffer(r["bounds"]))
    f, x = np.concatenate(feature), np.concatenate(bound)
    order = np.lexsort((x, f))
    f, x = f[order], x[order]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:] != f[:-1]) | (x[1:] != x[:-1])
    f, x = f[new], x[new]
    at_zero = np.flatnonzero(x == 0)
    return Bins(x, np.searchsorted(f, np.arange(width + 1)) + np.arange(width + 1), at_zero + f[at_zero])


@dataclass
class Numbered:
    """Bins, and y, copies and bins of the stored values of every row, written."""

    bins: Bins
    table: DataFrame


def numbered(ready: DataFrame, copies: str | None = None) -> Numbered:
    """ready (y and features, and copies where it is named) with bins in place of values."""
    ship(ready.sparkSession)
    bins = bounded(ready, copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = stored(batch.column("features"))
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bins.number(feature, value).astype(np.int32)))
            yield pa.record_batch([pa.array(batch.column("y").to_numpy().astype(np.int32)), batch.column("copies"), lists], names=["y", "copies", "bins"])

    rows = ready.select("y", (F.col(copies) if copies else F.lit(1)).cast("int").alias("copies"), "features")
    return Numbered(bins, written(rows.mapInArrow(run, "y int, copies int, bins array<int>"), "binned"))
