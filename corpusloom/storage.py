"""Tables that are written once and read by what follows: several passes then see the same rows."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Whether a query's shuffle files go when it ends, and not when the driver's collector happens to find them unused.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session (tests) gets a
    folder of its own; on a cluster it has to be set, as executors cannot read the driver's folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def unshuffled(spark: SparkSession) -> Iterator[None]:
    """Queries made and run within lose their shuffle files as they end."""
    kept = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if kept is None else spark.conf.set(_CLEANUP, kept)


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back. The files stay until that folder is cleaned, or spent(); what was shuffled
    to make them goes at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/corpusloom/{label}-{uuid.uuid4().hex}.parquet"
    with unshuffled(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes the files of results of written() that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
