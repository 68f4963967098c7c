"""What the operators of this subpackage have in common: shared storage, size-checked broadcasts, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.storage import spent, written  # noqa: F401

#: A side of a join is broadcast only if it has been counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 200_000
#: ... and so many bytes of strings and binaries.
BROADCAST_BYTES = 64_000_000
#: A key of more than one in so many of all rows is hot; rows of hot keys are dealt to so many places.
HOT_KEYS, HOT_SALTS = 1_000, 4_096
#: Rows of an Arrow batch while tables are written: rows may hold long texts or sets.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The white space of the word definitions: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: ends its lineage, and fixes generated ids.

    The files outlive executors. They stay until spent() or until the folder is cleaned, as a lazy result may still read them.
    """
    spark = df.sparkSession
    rows = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(rows), BATCH_ROWS) if int(rows) > 0 else BATCH_ROWS))
    try:
        return written(df, label)
    finally:
        spark.conf.set(_BATCH, rows)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if it has at most `rows` rows, and most_bytes in its strings, binaries and lists; else as it is, for a
    shuffled join that adaptive execution may split. df must be narrow and cheap to read (the result of cut())."""
    kind = lambda f: f.dataType.simpleString()
    long = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long") for f in df.schema if kind(f) in ("string", "binary")]
    long += [F.coalesce(8 * F.size(f.name), F.lit(0)).cast("long") for f in df.schema if kind(f) == "array<bigint>"]
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(long, F.lit(0).cast("long"))), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= most_bytes else df


def apart(docs: DataFrame, *columns: str) -> list:
    """docs with its columns under private names, which no caller's column can clash with, and the private names of `columns`.
    restored() gives the names back."""
    names = docs.columns
    places = [names.index(c) if c in names else [n.lower() for n in names].index(c.lower()) for c in columns]
    return [docs.toDF(*(f"own_{i}" for i in range(len(names)))), *(f"own_{i}" for i in places)]


def restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, in their order and by their names, of rows that come from apart(docs)."""
    return df.select(*(f"own_{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def matched(rows: DataFrame, key: str, table: DataFrame, weight: str, spread: Column) -> DataFrame:
    """rows joined (left) to table, a result of cut() with one row per key, by the column `key` of both; no task gets a hot key.

    weight, a column of table, is how many rows have the key. Keys of more than one in HOT_KEYS of all these are at most
    HOT_KEYS, and are broadcast; rows that they match are dealt out by `spread`, a whole number, all others by key.
    """
    joined = small(table)
    if joined is not table:  # few enough as a whole
        return rows.join(joined, key, "left")
    names = [c for c in table.columns if c != key]
    hot = F.col(weight) * HOT_KEYS > (table.agg(F.sum(weight)).first()[0] or 0)
    first = table.where(hot).select(key, F.struct(*names).alias("_hot"))
    rest = table.where(~hot).select(F.col(key).alias("_key"), F.lit(0).alias("_zero"), F.struct(*names).alias("_cold"))
    marked = rows.withColumn("_spread", spread).join(F.broadcast(first), key, "left")  # at most HOT_KEYS rows
    cold = F.col("_hot").isNull()
    marked = marked.withColumns({"_dealt": F.when(cold, F.col(key)), "_salt": F.when(cold, 0).otherwise(1 + F.pmod("_spread", F.lit(HOT_SALTS))).cast("int")})
    out = marked.join(rest, (F.col("_dealt") == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return out.select(*rows.columns, *(F.col(f"_found.{c}").alias(c) for c in names))


def chunks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices Arrow batches so that one slice holds about most_bytes of `column`, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * most_bytes / max(1, batch.column(column).nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session if it has Spark's default of 10 000 rows: a row may hold a long document."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


#: What operators keep in a worker between tasks, by operator, and how to drop it.
caches: dict[str, Callable[[], None]] = {}
_owner = ""


def claim(operator: str) -> None:
    """Called in a worker when an operator's task begins: those of other operators lose their caches, as workers are used
    again and their memory adds up."""
    global _owner
    if _owner != operator:
        for name, drop in caches.items():
            if name != operator:
                drop()
        give_back()
        _owner = operator


def give_back() -> None:
    """Returns a worker's free memory to the system: workers stay for a while after their task."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # not every C library gives memory back
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
