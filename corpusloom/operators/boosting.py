"""Gradient-boosted trees, one against the rest, with first- and second-order gains over binned sparse features.

All rows are fitted. Each of the tasks that fit holds its share of the features, of all rows; of each node the tasks exchange
their best splits, and which rows go right. Predictions run over all rows in the workers.
"""

from __future__ import annotations

import io
import os
import socket
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from multiprocessing.connection import Client, Listener

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.bins import Bins, Numbered, flat, numbered
from corpusloom.shipping import ship
from corpusloom.storage import spent, unshuffled

#: Weight that shrinks leaves, least sum of second derivatives in a leaf, least gain of a split.
SHRINK, LEAST, GAIN = 1.0, 1.0, 1e-6


@dataclass
class Values:
    """Stored values in order of feature and bin: the row of each, where those of each bin start (and the end), features (places
    among those of a share), and the first bin of each feature."""

    row: np.ndarray
    cuts: np.ndarray
    features: np.ndarray
    starts: np.ndarray

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """What the rows of each bin weigh, in whole numbers; that the running sum passes 2^63 does not change its differences."""
        return np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(np.take(weight, self.row))])[self.cuts])

    def by_feature(self, sums: np.ndarray) -> np.ndarray:
        return np.add.reduceat(sums, self.starts) if len(self.starts) else np.empty(0, np.int64)

    def sizes(self) -> np.ndarray:
        """Bins of each feature."""
        return np.diff(self.starts, append=len(self.cuts) - 1)

    def of_rows(self, there: np.ndarray) -> Values:
        keep = np.take(there, self.row)
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
        return Values(np.take(self.row, np.flatnonzero(keep)), upto[self.cuts], self.features, self.starts)

    def of_features(self, ok: np.ndarray) -> tuple[Values, np.ndarray]:
        """Those of the features that are ok, and which bins these have."""
        bins, counts = np.repeat(ok, self.sizes()), np.diff(self.cuts)
        sizes = self.sizes()[ok]
        return Values(self.row[np.repeat(bins, counts)], np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[bins])]), self.features[ok], np.cumsum(sizes) - sizes), bins

    def heavy(self, sums: np.ndarray, least: float) -> np.ndarray | None:
        """The features whose sum is least or more, or None where these have most of the values or bins: leaving out the others
        is worth it only where they are many."""
        ok = self.by_feature(sums) >= least
        ends = self.cuts[np.append(self.starts, len(self.cuts) - 1)]
        few = np.diff(ends)[ok].sum() < 0.7 * len(self.row) or self.sizes()[ok].sum() < 0.7 * (len(self.cuts) - 1)
        return ok if few else None


@dataclass
class Node:
    """Rows of a node, values that include theirs (and may include those of rows of which covered is the number), and what these
    rows' values weigh by bin."""

    rows: np.ndarray
    values: Values
    covered: int
    g: np.ndarray
    h: np.ndarray
    best: tuple[float, int, int] | None = None


class Binned:
    """The stored values of some features, of all rows, by bin; a feature's bin for zero is in its place among the others."""

    def __init__(self, vectors):
        row, feature, value = flat(vectors)
        bins = Bins.of(feature, value, int(feature.max()) + 1 if len(feature) else 0)
        self._hold(bins, 0, 1, len(vectors), row.astype(np.int32), bins.number(feature, value))

    @classmethod
    def share(cls, bins: Bins, share: int, shares: int, n: int, row: np.ndarray, number: np.ndarray) -> Binned:
        """The features whose remainder by shares is share, of n rows; number has bins of all features."""
        out = cls.__new__(cls)
        out._hold(bins, share, shares, n, row, number)
        return out

    def _hold(self, bins: Bins, share: int, shares: int, n: int, row: np.ndarray, number: np.ndarray) -> None:
        self.all, self.n = bins, n
        self.names = np.arange(share, len(bins.starts) - 1, shares)
        sizes = (bins.starts[1:] - bins.starts[:-1])[self.names]
        starts = np.cumsum(sizes) - sizes
        self.zero = bins.zero[self.names] - bins.starts[self.names]  # place among its feature's bins
        count = int(sizes.sum())
        place = np.full(int(bins.starts[-1]), -1, np.int32)
        place[np.repeat(bins.starts[self.names] - starts, sizes) + np.arange(count)] = np.arange(count)
        bin = place[number]
        cuts = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(bin, minlength=count))])
        self.values = Values(row[np.argsort(bin, kind="stable")].astype(np.int64), cuts, np.arange(len(self.names)), starts)

    def judge(self, node: Node, g: int, h: int, unit: float) -> None:
        """Finds the node's best split: gain, feature, last bin that goes left. g and h are the sums of the node's rows, in whole
        numbers of 1 / unit, so that all sums are exact in any order."""
        # One side of a split has no zeros, and so no more than the feature's stored values.
        ok = node.values.heavy(node.h, LEAST * unit)
        if ok is not None:
            node.values, bins = node.values.of_features(ok)
            node.g, node.h = node.g[bins], node.h[bins]
        v = node.values
        if not len(v.starts):
            return
        feature, zero = np.repeat(np.arange(len(v.starts)), v.sizes()), v.starts + self.zero[v.features]
        sides = []
        for stored, total in ((node.g, g), (node.h, h)):
            found = stored.copy()
            found[zero] += total - v.by_feature(stored)
            run = np.cumsum(found)
            left = run - (run[v.starts] - found[v.starts])[feature]
            sides.append((left / unit, (total - left) / unit, total / unit))
        (gl, gr, gt), (hl, hr, ht) = sides
        fits = (hl >= LEAST) & (hr >= LEAST)
        gain = np.where(fits, gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK), 0) - gt**2 / (ht + SHRINK)
        at = int(np.argmax(gain))
        if fits[at] and gain[at] > GAIN:
            node.best = float(gain[at]), int(self.names[v.features[feature[at]]]), at

    def right(self, node: Node) -> np.ndarray:
        """Who of the node's rows goes right by its best split."""
        v, at = node.values, node.best[2]
        k = int(np.searchsorted(v.starts, at, side="right")) - 1
        end = np.append(v.starts, len(v.cuts) - 1)[k + 1]
        out = np.full(self.n, v.starts[k] + self.zero[v.features[k]] > at)
        out[v.row[v.cuts[v.starts[k]] : v.cuts[at + 1]]] = False
        out[v.row[v.cuts[at + 1] : v.cuts[end]]] = True
        return out[node.rows]

    def bound(self, node: Node) -> float:
        """The largest value that goes left."""
        v, at = node.values, node.best[2]
        return self.all.bound(int(self.all.starts[node.best[1]] + at - v.starts[np.searchsorted(v.starts, at, side="right") - 1]))

    def split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float, np.ndarray] | None:
        """The best split of rows by these features: feature, largest value that goes left, and who goes right."""
        unit = unit_of(np.abs(g).sum() + h.sum())
        whole = np.zeros((2, self.n), np.int64)
        whole[:, rows] = np.rint(g * unit), np.rint(h * unit)
        node = Node(rows, self.values, self.n, *map(self.values.sums, whole))
        self.judge(node, *map(int, whole.sum(axis=1)), unit)
        return (node.best[1], self.bound(node), self.right(node)) if node.best else None


def unit_of(most: float) -> float:
    """A power of 2 by which sums up to most stay whole numbers that floats hold exactly."""
    return 2.0 ** (51 - np.ceil(np.log2(max(most, 1))))


def alone(said):
    """The exchange of a task that holds all features."""
    return [said]


def grown(data: Binned, y: np.ndarray, rounds: int, depth: int, step: float, copies: np.ndarray | None = None, met: Callable = alone, place: int = 0) -> dict[str, np.ndarray]:
    """Trees as arrays (rounds, nodes): feature (-1: leaf), bound, value; node i has the children 2i + 1 and 2i + 2.

    met gives what each share's task says at that point, in order; this one's is at place. All tasks take the same steps, as
    these depend on what was said only.
    """
    nodes = 2 ** (depth + 1) - 1
    out = {"feature": np.full((rounds, nodes), -1, np.int64), "bound": np.zeros((rounds, nodes)), "value": np.zeros((rounds, nodes))}
    margin = np.zeros(data.n)
    weight = np.ones(data.n, np.int64) if copies is None else copies.astype(np.int64)
    unit = unit_of(float(weight.sum()))
    every, there = np.arange(data.n, dtype=np.int32), np.zeros(data.n, bool)
    live, then = None, None
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.rint(x * unit).astype(np.int64) * weight for x in (p - y, np.maximum(p * (1 - p), 1e-16)))
        splits = h.sum() >= 2 * LEAST * unit
        # Features whose values had less than half of LEAST have less than LEAST until all rows together gained the other half.
        if splits and (live is None or np.maximum(h - then, 0).sum() >= LEAST * unit / 2):
            live, then = data.values, h
        root = Node(every, live, data.n, live.sums(g), live.sums(h)) if splits else Node(every, data.values, data.n, g, h)
        if splits and (ok := live.heavy(root.h, LEAST * unit / 2)) is not None:
            (live, bins), then = live.of_features(ok), np.minimum(then, h)
            root.values, root.g, root.h = live, root.g[bins], root.h[bins]
        todo = {0: root}
        while todo:
            sums = {k: (int(g[n.rows].sum()), int(h[n.rows].sum())) for k, n in todo.items()}
            for k, n in todo.items():
                if 2 * k + 2 < nodes and sums[k][1] >= 2 * LEAST * unit:
                    data.judge(n, *sums[k], unit)
            offers = met({k: (-n.best[0], n.best[1], data.bound(n)) for k, n in todo.items() if n.best})
            won = {k: min((o[k], i) for i, o in enumerate(offers) if k in o) for k in todo if any(k in o for o in offers)}
            mine = {k: np.packbits(data.right(todo[k])) for k, (_, i) in won.items() if i == place}
            halves = {k: bits for said in (met(mine) if won else []) for k, bits in said.items()}
            below = {}
            for k, n in todo.items():
                if k not in won:
                    out["value"][t, k] = -step * (sums[k][0] / unit) / (sums[k][1] / unit + SHRINK)
                    margin[n.rows] += out["value"][t, k]
                    continue
                out["feature"][t, k], out["bound"][t, k] = won[k][0][1:]
                right = np.unpackbits(halves[k], count=len(n.rows)).astype(bool)
                few, many = sorted(((2 * k + 1, n.rows[~right]), (2 * k + 2, n.rows[right])), key=lambda x: len(x[1]))
                if 4 * k + 4 >= nodes or max(h[few[1]].sum(), h[many[1]].sum()) < 2 * LEAST * unit:  # the children are leaves
                    below |= {c: Node(rows, n.values, n.covered, n.g, n.h) for c, rows in (few, many)}
                    continue
                there[few[1]] = True
                own = n.values.of_rows(there)
                there[few[1]] = False
                less = Node(few[1], own, len(few[1]), own.sums(g), own.sums(h))
                more = Node(many[1], n.values, n.covered, n.g - less.g, n.h - less.h)
                if 2 * len(more.rows) < more.covered:
                    there[more.rows] = True
                    more.values, more.covered = more.values.of_rows(there), len(more.rows)
                    there[more.rows] = False
                below |= {few[0]: less, many[0]: more}
            todo = below
    return out


def margins(trees: dict[str, np.ndarray], vectors) -> np.ndarray:
    """Sum of the leaves that each vector falls into."""
    feature, bound, value = trees["feature"], trees["bound"], trees["value"]
    names = np.unique(feature[feature >= 0])
    row, found, x = flat(vectors)
    at = np.searchsorted(names, found)
    known = at < len(names)
    known[known] = names[at[known]] == found[known]
    table = np.zeros((len(vectors), len(names) + 1))  # the last column serves leaves
    table[row[known], at[known]] = x[known]
    column = np.where(feature >= 0, np.searchsorted(names, feature), len(names))
    tree, rows = np.arange(len(feature))[None, :], np.arange(len(vectors))[:, None]
    node = np.zeros((len(vectors), len(feature)), np.int64)
    for _ in range(int(np.log2(feature.shape[1] + 1)) - 1):
        down = 2 * node + 1 + (table[rows, column[tree, node]] > bound[tree, node])
        node = np.where(feature[tree, node] >= 0, down, node)
    return value[tree, node].sum(axis=1)


@dataclass
class Boosting:
    """Settings; fit takes columns key, y (0, 1, ...) and features, and where copies is named, that column says how many rows a
    row stands for. All rows are fitted, unless sample asks for so many, those whose keys have the smallest hashes."""

    key: str
    rounds: int = 500
    depth: int = 7
    step: float = 0.2
    sample: int | None = None
    copies: str | None = None

    def fit(self, ready: DataFrame, made: Numbered | None = None) -> Boosted:
        """A model per class that the rows have. made is what numbered() makes of ready, where that is there already."""
        spark = ready.sparkSession
        ship(spark)
        rows, copies = ready, self.copies
        if self.sample is not None:
            order = F.xxhash64(self.key), F.col(self.key), F.col("y")
            rows = rows.orderBy(*order).limit(self.sample)
            if copies:
                rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).orderBy(*order).limit(self.sample)
            made, copies = None, None
        own = made or numbered(rows, copies)
        held = spark.sparkContext._jsc.sc()
        shares = max(1, held.maxNumConcurrentTasks(held.resourceProfileManager().defaultResourceProfile()))  # they have to run at once
        with unshuffled(spark):
            # a task for each share, whatever the number of shuffle partitions
            parts = own.table.mapInArrow(_dealt(own.bins, shares), "share int, part int, seq int, y binary, copies binary, upto binary, bins binary").repartitionById(shares, "share")
            models = parts.mapInArrow(_fitted(own.bins, shares, self.rounds, self.depth, self.step), "c double, model binary", barrier=True).collect()  # trees of a class: rounds * 2^depth nodes at most
        if not made:
            spent(own.table)
        return Boosted({r["c"]: bytes(r["model"]) for r in models})


def _dealt(bins: Bins, shares: int):
    """Rows, as blocks for each share: what all shares need of them, and the bins of the share's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = np.repeat(np.arange(len(bins.starts) - 1) % shares, np.diff(bins.starts)).astype(np.int32)
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(batches):
            lists = batch.column("bins")
            row, number = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            share = to[number]
            parts = []
            for s in range(shares):
                use = share == s
                upto = np.searchsorted(row[use], np.arange(batch.num_rows + 1)).astype(np.int32)
                parts.append((s, part, seq, *(x.tobytes() for x in (batch.column("y").to_numpy(), batch.column("copies").to_numpy(), upto, number[use]))))
            kinds = (pa.int32(),) * 3 + (pa.binary(),) * 4
            yield pa.record_batch([pa.array([p[k] for p in parts], t) for k, t in enumerate(kinds)], names=["share", "part", "seq", "y", "copies", "upto", "bins"])

    return run


def _fitted(bins: Bins, shares: int, rounds: int, depth: int, step: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for b in batches:
            blocks += b.to_pylist()
        blocks.sort(key=lambda b: (b["part"], b["seq"]))  # the same rows in the same order as in every other task
        whole = lambda name: np.concatenate([np.empty(0, np.int32), *(np.frombuffer(b[name], np.int32) for b in blocks)])
        y, copies, number = whole("y"), whole("copies"), whole("bins")
        row = np.repeat(np.arange(len(y), dtype=np.int32), np.concatenate([np.empty(0, np.int32), *(np.diff(np.frombuffer(b["upto"], np.int32)) for b in blocks)]).astype(np.int32))
        del blocks
        place = BarrierTaskContext.get().partitionId()
        data = Binned.share(bins, place, shares, len(y), row, number)
        del number
        with Meeting(place, shares) as met:
            for c in np.unique(y).tolist():
                trees = grown(data, (y == c).astype(float), rounds, depth, step, copies, met, place)
                if not place:
                    file = io.BytesIO()
                    np.savez_compressed(file, **trees)
                    yield pa.record_batch([pa.array([float(c)]), pa.array([file.getvalue()], pa.binary())], names=["c", "model"])

    return run


class Meeting:
    """An exchange among the tasks of a barrier stage: each says something, and gets what all said, in order. Task 0 passes it on."""

    def __init__(self, place: int, tasks: int):
        self.place, self.tasks = place, tasks

    def __enter__(self) -> Callable:
        context = BarrierTaskContext.get()
        host = context.getTaskInfos()[0].address.rsplit(":", 1)[0]
        if self.place:
            port, key = context.allGather("")[0].split()
            self.ends = [Client((host, int(port)), authkey=bytes.fromhex(key))]
            self.ends[0].send(self.place)
        else:
            key = os.urandom(16)
            with Listener((host, 0), backlog=self.tasks, authkey=key) as door:
                context.allGather(f"{door.address[1]} {key.hex()}")
                ends = [door.accept() for _ in range(self.tasks - 1)]
            named = {end.recv(): end for end in ends}
            self.ends = [named[k] for k in range(1, self.tasks)]
        for end in self.ends:  # small messages are not to wait for more
            with socket.socket(fileno=os.dup(end.fileno())) as s:
                s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        return self.met

    def met(self, said):
        if self.place:
            self.ends[0].send(said)
            return self.ends[0].recv()
        every = [said, *(end.recv() for end in self.ends)]
        for end in self.ends:
            end.send(every)
        return every

    def __exit__(self, *_) -> None:
        for end in self.ends:
            end.close()


@dataclass
class Boosted:
    models: dict[float, bytes]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with prediction: the class of the largest margin, the first of equal ones, null without any class. The column
        features goes."""
        models = sorted(self.models.items())
        kept = [c for c in df.columns if c != "features"]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trees = [dict(np.load(io.BytesIO(m))) for _, m in models]
            classes = np.array([c for c, _ in models])
            for frame in frames:
                for start in range(0, len(frame), 500):
                    part = frame.iloc[start : start + 500]
                    vectors = part["features"].to_list()
                    out = part[kept].copy()
                    out["prediction"] = classes[np.argmax([margins(t, vectors) for t in trees], axis=0)] if trees else None
                    yield out

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
        return df.mapInPandas(run, f"{schema}, prediction double")
