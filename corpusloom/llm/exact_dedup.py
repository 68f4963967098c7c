"""Operator 7, exact duplicates by a cuckoo-filter index.

Digests of normalised texts are dealt to buckets. Each bucket has a cuckoo filter, which knows short fingerprints, and the
bucket's content: stored keys with their texts. A digest that the filter has not seen is new; a hit is verified against the
content. Digests can be deleted, and a filter that overflows is rebuilt larger from the stored keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import apart, chunks, claim, cut, give_back, matched, restored, small
from corpusloom.shipping import ship

SLOTS, KICKS = 4, 200
#: Bytes of texts that a task combines before they are dealt out.
COMBINE_BYTES = 8_000_000
#: Buckets that digests are dealt to, and bytes of texts after which an index ends with its bucket.
BUCKETS, INDEX_BYTES = 1 << 20, 32_000_000
_DROP = str.maketrans("", "", " \t\n\x0b\f\r")


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of SLOTS; a key lies in one of two buckets that follow from each other."""

    def __init__(self, capacity: int) -> None:
        size = 1
        while size * SLOTS * 0.85 < capacity:
            size *= 2
        self.mask, self.table, self.count, self._turn = size - 1, [[] for _ in range(size)], 0, 0

    def _places(self, key: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, at: int, print_: int) -> int:
        return (at ^ (print_ * 0x5BD1E995)) & self.mask

    def __contains__(self, key: bytes) -> bool:
        print_, a, b = self._places(key)
        return print_ in self.table[a] or print_ in self.table[b]

    def add(self, key: bytes) -> bool:
        """False if no place was found: the filter is to be rebuilt larger (a fingerprint may have lost its place)."""
        print_, a, b = self._places(key)
        for at in (a, b):
            if len(self.table[at]) < SLOTS:
                self.table[at].append(print_)
                self.count += 1
                return True
        at = a
        for _ in range(KICKS):
            self._turn = (self._turn + 1) % SLOTS
            self.table[at][self._turn], print_ = print_, self.table[at][self._turn]
            at = self._other(at, print_)
            if len(self.table[at]) < SLOTS:
                self.table[at].append(print_)
                self.count += 1
                return True
        return False

    def remove(self, key: bytes) -> bool:
        """Takes out one fingerprint of a key that is known to be in."""
        print_, a, b = self._places(key)
        for at in (a, b):
            if print_ in self.table[at]:
                self.table[at].remove(print_)
                self.count -= 1
                return True
        return False


class CuckooIndex:
    """Live digests with their content: the filter in front, stored keys and texts behind it, which only hits look up."""

    def __init__(self, capacity: int = 1024) -> None:
        self.filter, self.content, self.resizes, self.probes = CuckooFilter(capacity), {}, 0, 0

    def find(self, key: bytes, text: str):
        """The value stored for this key, or None: at once if the filter does not know it. A hit is verified against key and text."""
        if key not in self.filter:
            return None
        self.probes += 1
        stored = self.content.get(key)
        if stored is None:
            return None
        if stored[0] != text:
            raise ValueError("two texts with one SHA-256")
        return stored[1]

    def insert(self, key: bytes, text: str, value) -> None:
        """Stores a key that find() did not find."""
        self.content[key] = (text, value)
        if not self.filter.add(key):
            self._grow()

    def delete(self, key: bytes) -> bool:
        """Takes a live digest out; False if it is not in."""
        if key not in self.filter or self.content.pop(key, None) is None:
            return False
        return self.filter.remove(key)

    def _grow(self) -> None:
        capacity = 2 * max(len(self.content), (self.filter.mask + 1) * SLOTS)
        while True:
            self.filter, self.resizes = CuckooFilter(capacity), self.resizes + 1
            if all(self.filter.add(k) for k in self.content):
                return
            capacity *= 2

    def items(self) -> Iterator[tuple[bytes, str, object]]:
        for key, (text, value) in self.content.items():
            yield key, text, value


def better(a: tuple, b: tuple) -> tuple:
    """Of (code points, id, rows like this one): most code points, then smallest id; a null id is the last."""
    if a[:2] == b[:2]:
        return (*a[:2], a[2] + b[2])
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    return a if rank(a) <= rank(b) else b


_PARTIAL = "digest binary, norm string, n_points long, best_id long, ties long, n long"
_GROUPS = "digest binary, keep_points long, keep_id long, ties long, group_size long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["digest", "norm", "n_points", "best_id", "ties", "n"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the shuffle: one row for each text of some MB, with the row that stays and the count."""
    claim("exact")
    seen: dict[str, tuple] = {}
    held = 0
    for batch in chunks(batches, "text", COMBINE_BYTES):
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            norm, row = (text or "").translate(_DROP), (len(text or ""), i, 1)
            had = seen.get(norm)
            held += 0 if had else len(norm)
            seen[norm] = (better(had[0], row), had[1] + 1) if had else (row, 1)
        if held >= COMBINE_BYTES:
            yield _batch([(hashlib.sha256(t.encode()).digest(), t, *best, n) for t, (best, n) in seen.items()])
            seen, held = {}, 0
    if seen:
        yield _batch([(hashlib.sha256(t.encode()).digest(), t, *best, n) for t, (best, n) in seen.items()])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket stand together. Every partial row goes through a cuckoo index; an index takes whole buckets, and the
    next bucket starts a new one when it holds INDEX_BYTES of texts."""
    claim("exact")
    index, held, last = CuckooIndex(), 0, None
    for batch in chunks(batches, "norm"):
        for bucket, key, text, *row, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "digest", "norm", "n_points", "best_id", "ties", "n")), strict=True):
            if bucket != last and held >= INDEX_BYTES:
                yield from _found(index)
                index, held = CuckooIndex(), 0
            last, had = bucket, index.find(key, text)
            if had is None:
                held += len(text)
                index.insert(key, text, [tuple(row), n])
            elif (best := better(had[0], tuple(row))) is had[0] or best[:2] == had[0][:2]:  # the live row stays
                had[:] = best, had[1] + n
            else:  # a later row takes its place: the live digest goes, the other's comes
                index.delete(key)
                index.insert(key, text, [best, had[1] + n])
    yield from _found(index)
    del index
    give_back()


def _found(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    rows = [(key, *best, n) for key, _, (best, n) in index.items()]
    for start in range(0, len(rows), 10_000):
        keys, *numbers = zip(*rows[start : start + 10_000], strict=True)
        yield pa.record_batch([pa.array(keys, pa.binary()), *(pa.array(x, pa.int64()) for x in numbers)], names=["digest", "keep_points", "keep_id", "ties", "group_size"])


def normalised(text):
    """The text without white space of the ASCII range; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: digest, keep_points, keep_id, ties (rows equal to the kept one), group_size.

    Copies are combined before the shuffle, so a text that fills a third of the table reaches its bucket as one row for
    each 8 MB of a task. Buckets are sorted within their shuffle partition, which may be of any size: a task holds one index of
    INDEX_BYTES and a bucket more.
    """
    ship(docs.sparkSession)
    partial = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_combine, _PARTIAL)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partial.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).cast("int"))
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_merge, _GROUPS)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("digest", F.unhex(F.sha2(normalised(F.col(text)), 256))).withColumn("points", F.coalesce(F.length(text), F.lit(0)))


def _stays(row_id: str) -> Column:
    return F.col("group_size").isNull() | (F.col(row_id).eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")))


def _groups_of_two(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """The groups of two rows or more, and whether some of them have ties."""
    groups = cut(duplicate_groups(docs, id_col, text_col).where("group_size > 1"), "groups")
    return groups, not groups.where("ties > 1").isEmpty()


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    The row with the most code points stays, then the smallest id (null last); of rows that are equal in both, the one with
    the smallest hash of its text, and one of those that are equal in all. Null and empty texts are one group. Tables without
    rows give none; columns other than the two named are not read. Only groups of two or more are joined to the rows; a hot
    group's rows are dealt to many tasks.
    """
    groups, ties = _groups_of_two(docs, id_col, text_col)
    rows = _keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").withColumn("order", F.xxhash64("text"))
    marked = matched(rows.drop("text"), "digest", groups, "group_size", F.xxhash64("doc_id", "order")).withColumn("kept", _stays("doc_id"))
    if ties:
        numbered = cut(marked.withColumn("row", F.monotonically_increasing_id()), "marked")
        first = numbered.where("kept AND ties > 1").groupBy("digest").agg(F.min(F.struct("order", "row"))["row"].alias("row")).select("row", F.lit(True).alias("first"))
        marked = numbered.join(small(cut(first, "first")), "row", "left").withColumn("kept", F.col("kept") & (F.col("first") | (F.coalesce("ties", F.lit(1)) == 1)))
        marked = marked.withColumn("kept", F.coalesce("kept", F.lit(False)))
    single = F.col("group_size").isNull()
    return marked.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that do not stay, all columns kept, whatever their names.

    Which rows stay is as in mark_duplicates; of rows that are equal in id and code points, the one with the smallest hash of
    all its columns. Only groups of two or more are joined to the documents, so texts move only if there are more than
    BROADCAST_ROWS such.
    """
    groups, ties = _groups_of_two(docs, id_col, text_col)
    own, row_id, text = apart(docs, id_col, text_col)
    joined = matched(_keyed(own, text), "digest", groups, "group_size", F.xxhash64(row_id, text))
    left = joined.where(_stays(row_id))
    if not ties:
        return restored(left, docs)
    names = own.columns
    among = left.where("ties > 1").withColumn("order", F.sha2(F.to_json(F.struct(*names)), 256))
    first = among.groupBy("digest").agg(F.min_by(F.struct(*names), "order").alias("r")).select("r.*")
    return restored(left.where("coalesce(ties, 1) = 1").select(*names).unionByName(first), docs)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, coalesce(length(text), 0) AS points FROM documents),
g AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY norm) AS group_size,
 first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""
