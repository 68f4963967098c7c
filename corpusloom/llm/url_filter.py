"""Operator 9, URL filters by a sorted digest array.

Rules lie in one file: their 64-bit xxHash keys in order, and the strings they stand for. A worker maps the file into
memory, looks up all keys of a batch by one binary search, and confirms hits against the strings, so that equal hashes of
different strings do no harm.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import chunks, cut
from corpusloom.shipping import ship

#: (verdict, host, path prefix): fixed by the contract of op9.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
DEFAULT = "allow"
#: An index of more bytes is not sent to every worker.
INDEX_BYTES = 256_000_000
_HEAD = np.dtype("<u8")


def usable(rules: Iterable[tuple[str, str, str]]) -> dict[tuple[str, str], str]:
    """Verdicts by host and path of the rules that can fit: paths begin with a slash or are empty. Of a rule that comes with
    both verdicts, block holds."""
    out: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if host and path[:1] in ("", "/") and out.get((host, path)) != "block":
            out[host, path] = verdict
    return out


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The index file: numbers of rules, of path lengths and of label counts; then keys in order, string ends, lengths of
    paths and numbers of host labels that rules have, verdicts, and the strings."""
    verdicts = usable(rules)
    rows = sorted((xxhash.xxh64_intdigest(h + p), (h + p).encode(), v == "block") for (h, p), v in verdicts.items())
    keys = np.array([r[0] for r in rows], "<u8")
    ends = np.cumsum([0, *(len(r[1]) for r in rows)]).astype("<u8")
    lengths, labels = (np.unique(x).astype("<u8") for x in ([len(p) for _, p in verdicts], [h.count(".") + 1 for h, _ in verdicts]))
    parts = [np.array([len(rows), len(lengths), len(labels)], "<u8"), keys, ends, lengths, labels, np.array([r[2] for r in rows], "u1")]
    return b"".join(p.tobytes() for p in parts) + b"".join(r[1] for r in rows)


class DigestIndex:
    """A mapped index file."""

    def __init__(self, path: str | Path) -> None:
        data = np.memmap(path, np.uint8, "r")
        n, m, h = data[:24].view(_HEAD).tolist()
        at = 24
        self.keys, at = data[at : at + 8 * n].view(_HEAD), at + 8 * n
        self.ends, at = data[at : at + 8 * (n + 1)].view(_HEAD), at + 8 * (n + 1)
        #: Lengths of paths and numbers of host labels that rules have: no others are looked up.
        self.lengths, at = data[at : at + 8 * m].view(_HEAD).tolist(), at + 8 * m
        self.labels, at = data[at : at + 8 * h].view(_HEAD).tolist(), at + 8 * h
        self.blocks, self.strings = data[at : at + n], data[at + n :]

    def find(self, probes: list[str]) -> list[int]:
        """The place of each string in the index, or -1: a binary search for all, then the strings are compared."""
        if not len(self.keys) or not probes:
            return [-1] * len(probes)
        digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        first, last = np.searchsorted(self.keys, digests, "left"), np.searchsorted(self.keys, digests, "right")
        out = [-1] * len(probes)
        for k in np.flatnonzero(first < last).tolist():
            wanted = probes[k].encode()
            for at in range(first[k], last[k]):
                if self.strings[self.ends[at] : self.ends[at + 1]].tobytes() == wanted:
                    out[k] = at
        return out


_open: dict[str, DigestIndex] = {}


def mapped(index: bytes) -> DigestIndex:
    """This process's mapping of an index; the bytes are written to its temporary folder once (a size-checked file)."""
    name = xxhash.xxh3_128_hexdigest(index)
    if name not in _open:
        os.makedirs(tempfile.gettempdir(), exist_ok=True)
        with tempfile.NamedTemporaryFile(suffix=".idx") as file:
            file.write(index)
            file.flush()
            _open[name] = DigestIndex(file.name)  # the mapping keeps the file after its name is gone
    return _open[name]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([at for c in "/?#" if (at := rest.find(c)) >= 0], default=len(rest))
    tail = rest[end:]
    stop = min([at for c in "?#" if (at := tail.find(c)) >= 0], default=len(tail))
    return rest[:end].translate(_LOWER), tail[:stop]


def probes_of(host: str, path: str, lengths: list[int], labels: list[int]) -> list[str]:
    """The parent domains of the host with the prefixes of the path that a rule could have, the longest first, and of equally
    long ones that with the longest host. The cost follows the rules' lengths, not the url's."""
    hosts, known = [], host.count(".") + 1
    for n in labels:
        if n <= known:
            hosts.append(host if n == known else ".".join(host.rsplit(".", n)[-n:]))
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    pairs = sorted(((h, p) for h in hosts for p in prefixes), key=lambda x: (len(x[0]) + len(x[1]), len(x[0])), reverse=True)
    return [h + p for h, p in pairs]


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict. Every url is judged by the longest rule (host and path)
    that fits, of equally long ones by that with the longest host, or by `default` where none does (rule null). Of a rule that
    comes with both verdicts, block holds; one whose path does not begin with a slash fits nothing, unless it is empty.

    The index is built on the driver and sent to the workers if it has at most INDEX_BYTES; above that a ValueError asks for
    judge_joined(), which joins instead. Null urls and urls without :// have an empty host and path, which no rule fits.
    Repeated rows give repeated rows, an empty table an empty one; other columns (html) are not read.
    """
    rules = list(rules)
    index = build_index(rules)
    if len(index) > INDEX_BYTES:
        raise ValueError("the rules are too large for every worker; use judge_joined()")
    ship(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(index)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = mapped(sent.value)
        for batch in chunks(batches, "url"):
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            probes = [probes_of(h, p, table.lengths, table.labels) if h else [] for h, p in parts]
            flat = [x for own in probes for x in own]
            places, at, rule, verdict = table.find(flat), 0, [], []
            for own in probes:
                hit = next((k for k in range(at, at + len(own)) if places[k] >= 0), None)
                rule.append(None if hit is None else flat[hit])
                verdict.append(default if hit is None else "block" if table.blocks[places[hit]] else "allow")
                at += len(own)
            arrays = [batch.column("page_id").cast(pa.int64()), *(pa.array(c, pa.string()) for c in ([h for h, _ in parts], [p for _, p in parts], rule, verdict))]
            yield pa.record_batch(arrays, names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).mapInArrow(rows, "page_id long, host string, path string, rule string, verdict string")


def judge_joined(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same as judge() for rule tables (verdict, host, path) of any size: probes meet rules by their string in a join.

    Rules with a null count as none. The driver gets the lengths of paths and the numbers of host labels that rules have, which
    are as many as the longest rule's characters at most; a url is probed at these only.
    """
    good = rules.where("verdict IS NOT NULL AND host <> '' AND (path = '' OR path LIKE '/%')")
    table = cut(good.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks")), "rules")
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
    known = table.agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths"), F.array_sort(F.collect_set(dots + 1)).alias("labels")).first()
    url = F.coalesce(F.col(url_col), F.lit(""))
    parsed = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("_u")).withColumn("_rest", F.when(F.instr("_u", "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise(""))
    host = F.regexp_extract("_rest", r"^([^/?#]*+)", 1)
    parsed = parsed.withColumn("_h", host).withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_h) + 1)"), r"^([^?#]*+)", 1))
    parsed = parsed.withColumn("host", F.translate("_h", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("_row", F.monotonically_increasing_id())
    parsed = cut(parsed.select("_row", "page_id", "host", "path"), "urls")
    numbers = lambda values: F.array(*map(F.lit, values)).cast("array<int>")
    sized = parsed.where("host <> ''").withColumns({"_n": dots + 1, "_lengths": F.filter(numbers(known["lengths"]), lambda n: n <= F.length("path")), "_labels": numbers(known["labels"])})
    probes = sized.select("_row", "path", "_lengths", F.explode(F.expr("transform(filter(_labels, n -> n <= _n), n -> substring_index(host, '.', -n))")).alias("host"))
    probes = probes.select("_row", "host", F.explode(F.expr("transform(_lengths, n -> left(path, n))")).alias("path"))
    rule = F.concat("host", "path")
    best = probes.join(table, ["host", "path"]).groupBy("_row").agg(F.max_by(F.struct(rule.alias("rule"), "blocks"), F.struct(F.length(rule), F.length("host"))).alias("_best"))
    verdict = F.when(F.col("_best").isNull(), default).when(F.col("_best.blocks"), "block").otherwise("allow")
    return parsed.join(best, "_row", "left").select("page_id", "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"))


_FITS = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
_SAYS = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in RULES)
SQL = rf"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, CASE {' '.join(_FITS)} END AS rule FROM c)
SELECT page_id, host, path, rule, CASE rule {_SAYS} ELSE '{DEFAULT}' END AS verdict FROM d
"""
