"""Operator 5, secret scans with corpus-wide ownership frequency, with DataFrame functions only.

Candidates are found by pattern, their values hashed, and the hashes counted over distinct repositories and owners. A value
of one owner looks live; one that many share is a copied example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import apart, cut, restored, small
from corpusloom.llm.spans import SPAN, found_sql, free_of, listed, listed_sql, matches, replaced, spans

#: Fixed by the contract. A run of hex digits is only searched for from its first digit and if long enough.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Added by the method: long random-looking words, with digits and letters.
GENERIC = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
GENERIC_KINDS = 10
#: A hash of so many owners is a copied example.
EXAMPLE_OWNERS = 3
KINDS = ("assign", "access", "hex", "generic")


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner: Column) -> DataFrame:
    """_row, doc_id, repo, owner and the sorted spans of each row of docs; written to the shared folder, without texts."""
    text = F.col("_text")
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(repo_col).alias("repo"), owner.alias("owner"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = out.withColumns({"_assign": matches(text, ASSIGN), "_access": matches(text, ACCESS), "_hex": matches(text, HEX), "_generic": matches(text, GENERIC)}).drop("_text")
    keyed = lambda x: x.withField("value", F.regexp_extract(x["value"], r"""^[^:=]*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", 1))
    found = F.concat(
        F.filter(F.transform(spans("_assign", "assign", 0), keyed), lambda x: F.length(x["value"]) >= 6),
        F.filter(spans("_access", "access", 1), lambda x: F.length(x["value"]) >= 20),
        spans("_hex", "hex", 2),
        F.filter(spans("_generic", "generic", 3), lambda x: _random(x["value"])),
    )
    out = out.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "repo", "owner", F.array_sort(found).cast(f"array<{SPAN}>").alias("found"))
    return cut(out, "candidates")


def _random(value: Column) -> Column:
    """Digits and letters, and at least GENERIC_KINDS different characters."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= GENERIC_KINDS)


def ownership(found: DataFrame) -> DataFrame:
    """One row per hash of a candidate's value: hash, repos, owners, example. Copies in one repository are counted out
    first, so a value that fills the corpus reaches its task as one row for each repository."""
    values = found.select("repo", "owner", F.explode("found").alias("f")).select("repo", "owner", F.sha2("f.value", 256).alias("hash"))
    named = values.groupBy("hash", "owner", "repo").agg(F.lit(1))
    by_owner = named.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    total = by_owner.groupBy("hash").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
    return total.withColumn("example", F.col("owners") >= EXAMPLE_OWNERS)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, base (array of spans by start, then kind), spans (base and the method's), live and
    example (numbers of spans of either kind).

    owner is an expression over docs; by default what stands before the first slash of the repository's name. Added to the
    base spans are long random-looking words whose hash belongs to fewer than EXAMPLE_OWNERS owners and that lie in no base
    span. A null text counts as empty; null repositories or owners count as one. Repeated rows are scanned each, and an
    empty table gives none.
    """
    owner = F.substring_index(F.col(repo_col), "/", 1) if owner is None else owner
    found = candidates(docs, id_col, text_col, repo_col, owner)
    verdicts = cut(ownership(found), "ownership")
    each = found.where("size(found) > 0").select("_row", F.explode("found").alias("f")).withColumn("hash", F.sha2("f.value", 256))
    judged = each.join(small(verdicts), "hash").groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("f.*", "example"))).alias("judged"))
    base = F.expr("filter(judged, x -> x.ord < 3)")
    judged_span = f"{SPAN[:-1]},example:boolean>"
    added = F.expr(free_of("filter(judged, x -> x.ord = 3 AND NOT x.example)", "base", judged_span))
    out = found.select("_row", "doc_id").join(judged, "_row", "left")
    out = out.withColumn("judged", F.expr(f"coalesce(judged, cast(array() as array<{judged_span}>))")).withColumn("base", base)
    out = out.withColumn("spans", F.array_sort(F.concat("base", added)))
    count = lambda flag: F.expr(f"cast(size(filter(spans, x -> x.example = {flag})) as bigint)")
    return out.select("doc_id", "base", "spans", count("false").alias("live"), count("true").alias("example"))


def secret_digests(scanned: DataFrame) -> DataFrame:
    """The digest columns of scan_secrets' result."""
    n = lambda kind: F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
    return scanned.select("doc_id", *map(n, KINDS[:3]), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), F.col("live").alias("n_live"), F.col("example").alias("n_example"))


def mask_secrets(scanned: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every live-looking span of scan_secrets' result replaced by [SECRET], for tables with unique ids. Spans that
    overlap are replaced as one."""
    live = scanned.select("doc_id", F.expr("filter(spans, x -> NOT x.example)").alias("spans"))
    own, row_id, text = apart(docs, id_col, text_col)
    joined = own.join(live, F.col(row_id).eqNullSafe(F.col("doc_id")), "left")
    return restored(joined.withColumn(text, F.when(F.size("spans") > 0, replaced(text, "spans", "'[SECRET]'")).otherwise(F.col(text))), docs)


#: Runs that the patterns above find from their first character are taken whole here, and filtered by length.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, split_part(source, '/', 1) AS owner, coalesce(text, '') AS t FROM documents),
a AS ({found_sql("assign", 0, ASSIGN)}), k AS ({found_sql("access", 1, ACCESS)}), h AS ({found_sql("hex", 2, "[0-9a-f]+")}), g AS ({found_sql("generic", 3, "[A-Za-z0-9+/_=-]+")}),
f AS (SELECT * FROM (SELECT * REPLACE (regexp_extract(v, '^[^:=]*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) AS v) FROM a) WHERE length(v) >= 6 UNION ALL SELECT * FROM k WHERE length(v) >= 20 UNION ALL SELECT * FROM h WHERE length(v) >= 24
 UNION ALL SELECT * FROM g WHERE length(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= {GENERIC_KINDS}),
o AS (SELECT v, count(DISTINCT owner) + max((owner IS NULL)::INT) >= {EXAMPLE_OWNERS} AS example FROM f JOIN d USING (rid) GROUP BY v),
j AS (SELECT f.*, example FROM f JOIN o USING (v)),
s AS (SELECT * FROM j WHERE ord < 3 OR (NOT example AND NOT EXISTS (SELECT 1 FROM j b WHERE b.rid = j.rid AND b.ord < 3 AND b.start < j.stop AND j.start < b.stop)))
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access, count(*) FILTER (WHERE ord = 2) AS n_hex,
 sha256({listed_sql("ord < 3")}) AS base_sha256, {listed_sql("ord IS NOT NULL")} AS spans, count(*) FILTER (WHERE NOT example) AS n_live, count(*) FILTER (WHERE example) AS n_example
FROM d LEFT JOIN s USING (rid) GROUP BY rid
"""
