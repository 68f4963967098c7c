"""A decision tree over binned sparse features, grown level by level: every row counts, and no row is made dense.

Workers count the classes of stored values by node, feature and bin; what zeros have follows from the node's own counts. The
counts are dealt out by feature, and of each node only the best split of each share goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.bins import Bins, Numbered, numbered
from corpusloom.operators.boosting import margins
from corpusloom.shipping import ship
from corpusloom.storage import spent, unshuffled

#: Counts that a task holds before it deals them out.
HELD = 4_000_000


def routed(row: np.ndarray, number: np.ndarray, rows: int, bins: Bins, split: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node that each row has come to. split has feature and last bin that goes left of the nodes that have children;
    row and number, of the stored values, ascend."""
    node, total = np.zeros(rows, np.int64), int(bins.starts[-1])
    if not split:
        return node
    size = max(split) + 1
    feature, last = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    for k, (f, t) in split.items():
        feature[k], last[k] = f, t
    place = row * total + number
    live = np.arange(rows)
    while len(live := live[node[live] < size]) and len(live := live[feature[node[live]] >= 0]):
        f = feature[node[live]]
        at = np.searchsorted(place, live * total + bins.starts[f])
        there = np.append(place, np.iinfo(np.int64).max)[at]
        own = np.where(there < live * total + bins.starts[f + 1], there - live * total, bins.zero[f])
        node[live] = 2 * node[live] + 1 + (own > last[node[live]])
    return node


def best_splits(key: np.ndarray, count: np.ndarray, totals: dict[int, np.ndarray], bins: Bins, least: int) -> list[tuple[int, float, int, int, list[int]]]:
    """Node, gain, feature, last bin that goes left, and classes left, of the best split of each node among these counts; of
    equal ones that of the first feature and bin. key is (node's place in totals * bins + bin) * classes + class."""
    if not len(key):
        return []
    nodes, total = list(totals), int(bins.starts[-1])
    of = np.array([totals[k] for k in nodes], np.int64)
    classes = of.shape[1]
    cell, back = np.unique(key // classes, return_inverse=True)
    table = np.zeros((len(cell), classes), np.int64)
    np.add.at(table, (back, key % classes), count)
    feature = np.searchsorted(bins.starts, cell % total, side="right") - 1
    group, member = np.unique(cell // total * len(bins.starts) + feature, return_inverse=True)
    here, which = group // len(bins.starts), group % len(bins.starts)
    zeros = of[here].copy()
    np.subtract.at(zeros, member, table)
    cell, table, member = np.concatenate([cell, here * total + bins.zero[which]]), np.concatenate([table, zeros]), np.concatenate([member, np.arange(len(group))])
    order = np.argsort(cell, kind="stable")
    cell, table, member = cell[order], table[order], member[order]
    run = np.cumsum(table, axis=0)
    first = np.searchsorted(member, np.arange(len(group)))
    left = run - (run[first] - table[first])[member]
    whole = of[here[member]]
    right = whole - left
    nl, nr = left.sum(axis=1), right.sum(axis=1)
    score = lambda part, n: (part.astype(float) ** 2).sum(axis=1) / np.maximum(n, 1)
    gain = np.where((nl >= least) & (nr >= least), score(left, nl) + score(right, nr) - score(whole, nl + nr), 0)
    out = []
    at = here[member]
    for k in np.unique(at).tolist():
        mine = np.flatnonzero(at == k) if len(nodes) > 1 else np.arange(len(at))
        top = mine[np.argmax(gain[mine])]
        if gain[top] > 1e-7:
            out.append((nodes[k], float(gain[top]), int(which[member[top]]), int(cell[top] % total), left[top].tolist()))
    return out


def _counted(bins: Bins, split: dict[int, tuple[int, int]], nodes: list[int], classes: int, shares: int):
    place = np.full(max(nodes) + 1, -1, np.int64)
    place[nodes] = np.arange(len(nodes))

    def dealt(key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        share = (np.searchsorted(bins.starts, key // classes % int(bins.starts[-1]), side="right") - 1) % shares
        order = np.argsort(share, kind="stable")
        cuts = np.searchsorted(share[order], np.arange(shares + 1))
        # keys ascend, so that their differences compress well
        parts = [(s, np.diff(key[o], prepend=0).tobytes(), count[o].tobytes()) for s in range(shares) if len(o := order[cuts[s] : cuts[s + 1]])]
        return pa.record_batch([pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["share", "key", "count"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            y, copies, lists = batch.column("y").to_numpy(), batch.column("copies").to_numpy(), batch.column("bins")
            row, number = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy().astype(np.int64)
            node = routed(row, number, len(y), bins, split)
            at = np.where(node < len(place), place[np.minimum(node, len(place) - 1)], -1)
            use = at[row] >= 0
            row, number = row[use], number[use]
            found = _summed([((at[row] * int(bins.starts[-1]) + number) * classes + y[row], copies[row])])
            held.append(found)
            size += len(found[0])
            if size > HELD:
                yield dealt(*_summed(held))
                held, size = [], 0
        if size:
            yield dealt(*_summed(held))

    return rows


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return key, np.bincount(back, weights=np.concatenate([p[1] for p in parts]), minlength=len(key)).astype(np.int64)


@dataclass
class DecisionTree:
    """Settings; fit takes columns key, y (0, 1, ...) and features, and where copies is named, that column says how many rows a
    row stands for. Splits are by Gini impurity."""

    key: str
    depth: int = 9
    least: int = 2
    copies: str | None = None

    def fit(self, ready: DataFrame, made: Numbered | None = None) -> FittedTree:
        """The tree of all rows of ready. made is what numbered() makes of it, where that is there already."""
        spark = ready.sparkSession
        ship(spark)
        copies = F.col(self.copies) if self.copies else F.lit(1)
        sized = {int(r["y"]): r["n"] for r in ready.groupBy("y").agg(F.sum(copies).alias("n")).collect()}  # labels, not rows
        if not sized:
            return FittedTree({k: np.full((1, 1), v) for k, v in (("feature", -1), ("bound", 0.0), ("value", np.nan))})
        classes = max(sized) + 1
        own = made or numbered(ready, self.copies)
        bins, table = own.bins, own.table
        slim = Bins(np.empty(0), bins.starts.astype(np.int32), bins.zero.astype(np.int32))  # goes to the tasks of every level
        shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
        totals, split = {0: np.array([sized.get(c, 0) for c in range(classes)], np.int64)}, {}
        leaf = dict(totals)
        for _ in range(self.depth):
            active = {k: t for k, t in totals.items() if t.sum() >= 2 * self.least and (t > 0).sum() > 1}
            if not active:
                break
            totals = {}
            for node, feature, last, left in self._level(table, slim, split, active, classes, shares):
                split[node] = (feature, last)
                for child, counts in ((2 * node + 1, left), (2 * node + 2, active[node] - left)):
                    totals[child] = leaf[child] = counts
        if not made:
            spent(table)
        size = 2 ** (self.depth + 1) - 1
        trees = {"feature": np.full((1, size), -1, np.int64), "bound": np.zeros((1, size)), "value": np.zeros((1, size))}
        for node, counts in leaf.items():
            trees["value"][0, node] = np.argmax(counts)
        for node, (feature, last) in split.items():
            trees["feature"][0, node], trees["bound"][0, node] = feature, bins.bound(last)
        return FittedTree(trees)

    def _level(self, table: DataFrame, bins: Bins, split: dict, active: dict[int, np.ndarray], classes: int, shares: int) -> list[tuple[int, int, int, np.ndarray]]:
        least = self.least

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(np.cumsum(np.frombuffer(k, np.int64)), np.frombuffer(n, np.int64)) for b in batches for k, n in zip(b.column("key").to_pylist(), b.column("count").to_pylist(), strict=True)]
            found = best_splits(*_summed(parts), active, bins, least) if parts else []
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array([r[k] for r in found], t) for k, t in enumerate(kinds)], names=["node", "gain", "feature", "last", "left"])

        with unshuffled(table.sparkSession):
            counted = table.mapInArrow(_counted(bins, split, list(active), classes, shares), "share int, key binary, count binary")
            found = counted.repartition(shares, "share").mapInArrow(best, "node long, gain double, feature long, last long, left array<bigint>").collect()  # a split of each node and task
        out: dict[int, tuple] = {}
        for r in sorted(found, key=lambda r: (r["node"], -r["gain"], r["feature"], r["last"])):
            out.setdefault(r["node"], (r["node"], r["feature"], r["last"], np.array(r["left"], np.int64)))
        return list(out.values())


@dataclass
class FittedTree:
    trees: dict[str, np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with prediction: the commonest class of the leaf, the first of equal ones, null without any row. The column
        features goes."""
        trees = self.trees
        kept = [c for c in df.columns if c != "features"]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for start in range(0, len(frame), 500):
                    part = frame.iloc[start : start + 500]
                    out = part[kept].copy()
                    out["prediction"] = margins(trees, part["features"].to_list())
                    yield out

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
        return df.mapInPandas(run, f"{schema}, prediction double")
