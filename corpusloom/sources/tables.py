"""Sources and sinks: string tables in CSV and ODS, row-id lists, checkpoints."""

from __future__ import annotations

import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom.operators.eda import in_first_order
from corpusloom.operators.qa import REPORT, SURE_REPORT
from corpusloom.operators.reports import as_strings, clean_names, ids_in_text, parsed_id


def read_strings(spark: SparkSession, path: str, id_name: str = "row_id") -> DataFrame:
    """A CSV with a header as strings: BOM and quoted newlines are understood, missing cells are empty, a nameless first
    column is the id."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False)
    if not df.columns:
        raise ValueError(f"{path} has no header")
    return as_strings(clean_names(df.toDF(*(id_name if n == "_c0" else n for n in df.columns))))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    return read_strings(spark, path) if exists(spark, path) else None


def write_strings(df: DataFrame, path: str, one_file: bool = False, columns: list[str] | None = None, unknown: str = "project", bom: bool = False) -> None:
    """Strings as CSV with a header, cells as they are; one_file is for exports that fit one task.

    columns are those to write, absent ones empty; other columns of df are left out, or raise if unknown is "raise". With bom
    each file begins with a byte order mark.
    """
    if columns is not None:
        if unknown == "raise" and (more := [c for c in df.columns if c not in columns]):
            raise ValueError(f"columns that the table does not have: {more[:10]}")
        df = df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in columns))
    out = as_strings(df)
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    (out.coalesce(1) if one_file else out).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_report(df: DataFrame, path: str, rebuild: bool = True, sure: bool = False) -> None:
    """A suspicious or (sure) high-confidence report with its 22 columns as CSV; absent ones are empty. An existing one is
    replaced only if rebuild is set."""
    if not rebuild and exists(df.sparkSession, path):
        raise FileExistsError(path)
    write_strings(df, path, columns=SURE_REPORT if sure else REPORT, bom=True)


def write_new(df: DataFrame, path: str, rebuild: bool = False) -> None:
    """A report as Parquet; an existing one is replaced only if rebuild is set."""
    df.write.mode("overwrite" if rebuild else "errorifexists").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """row_id and place of an id list: of the row_id column of a .csv, else every whole number of the text once, in order."""
    if path.lower().endswith(".csv"):
        df = read_strings(spark, path)
        if "row_id" not in df.columns:
            raise ValueError("the list has no row_id column")
        return df.select(F.coalesce(parsed_id(F.col("row_id")), F.raise_error(F.lit("a row id is no whole number")).cast("bigint")).alias("row_id"), F.monotonically_increasing_id().alias("place"))
    return spark.read.text(path, wholetext=True).select(F.posexplode(ids_in_text(F.col("value"))).alias("place", "row_id")).select("row_id", F.col("place").cast("bigint").alias("place"))


def chosen_ids(spark: SparkSession, inline: str = "", path: str = "") -> DataFrame:
    """Distinct ids of an inline list, then of a file, in the order in which they first come: row_id, place."""
    given = spark.createDataFrame([(inline,)], "value string").select(F.posexplode(ids_in_text(F.col("value"))).alias("place", "row_id"))
    both = given.select("row_id", F.struct(F.lit(0).alias("list"), F.col("place").cast("bigint").alias("at")).alias("place"))
    if path:
        both = both.unionByName(read_ids(spark, path).select("row_id", F.struct(F.lit(1).alias("list"), F.col("place").alias("at")).alias("place")))
    return in_first_order(both, "row_id", "place")


def write_checkpoint(spark: SparkSession, values: dict, path: str) -> None:
    spark.createDataFrame([values]).coalesce(1).write.mode("overwrite").json(path)


def read_checkpoint(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path, multiLine=True).first().asDict(recursive=True) if exists(spark, path) else {}


def should_sync(path: str, done: int, every: int, force: bool = False) -> bool:
    """Whether an ODS export is due after `done` batches."""
    return path.lower().endswith(".ods") and (force or (every > 0 and done % every == 0))


#: The namespaces of spreadsheet content.
_TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
_TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"
_OFFICE = "urn:oasis:names:tc:opendocument:xmlns:office:1.0"


def ods_rows(path: str) -> Iterator[list[str]]:
    """Rows of the first sheet, read as a stream; trailing empty cells and rows are left out."""
    with zipfile.ZipFile(path) as archive, archive.open("content.xml") as content:
        waiting = 0
        for _, node in ET.iterparse(content):
            if node.tag == f"{_TABLE}table":
                return
            if node.tag != f"{_TABLE}table-row":
                continue
            cells: list[str] = []
            for cell in node.iter(f"{_TABLE}table-cell"):
                text = "\n".join("".join(p.itertext()) for p in cell.iter(f"{_TEXT}p"))
                cells += [text] * min(int(cell.get(f"{_TABLE}number-columns-repeated", "1")), 16_384 if text else 1024)
            while cells and not cells[-1]:
                cells.pop()
            repeat = int(node.get(f"{_TABLE}number-rows-repeated", "1"))
            if not cells:
                waiting += repeat
            else:
                yield from ([] for _ in range(waiting))
                waiting = 0
                yield from (cells for _ in range(repeat))
            node.clear()


class OdsSource(DataSource):
    """`spark.read.format("ods").load(path)`: the first sheet as strings, its first row as names. One task reads a file."""

    @classmethod
    def name(cls) -> str:
        return "ods"

    def schema(self) -> StructType:
        names = next(ods_rows(self.options["path"]))
        return StructType([StructField(n.strip() or "row_id", StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _OdsReader(self.options["path"], len(schema))


class _OdsReader(DataSourceReader):
    def __init__(self, path: str, width: int) -> None:
        self.path, self.width = path, width

    def read(self, partition) -> Iterator[tuple]:
        rows = ods_rows(self.path)
        next(rows)
        for cells in rows:
            yield tuple((cells + [""] * self.width)[: self.width])


def write_ods(df: DataFrame, path: str) -> None:
    """A spreadsheet of one sheet, streamed row by row on the driver: an export format, not for large tables."""
    row = lambda cells: "<table:table-row>" + "".join("<table:table-cell>" + "".join(f"<text:p>{escape(x)}</text:p>" for x in c.split("\n")) + "</table:table-cell>" for c in cells) + "</table:table-row>"
    head = f'<office:document-content xmlns:office="{_OFFICE}" xmlns:table="{_TABLE[1:-1]}" xmlns:text="{_TEXT[1:-1]}"><office:body><office:spreadsheet><table:table table:name="data">'
    with zipfile.ZipFile(Path(path), "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("mimetype", "application/vnd.oasis.opendocument.spreadsheet", zipfile.ZIP_STORED)
        with archive.open("content.xml", "w") as content:
            content.write((head + row(df.columns)).encode())
            for r in as_strings(df).toLocalIterator():
                content.write(row(list(r)).encode())
            content.write(b"</table:table></office:spreadsheet></office:body></office:document-content>")
