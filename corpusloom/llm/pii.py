"""Operator 6, personal data and information-theoretic sanitisation, with DataFrame functions only.

Protected entities are found by pattern. All terms of an entity's documents are compared with it over the whole corpus: the
share of the entity's information that a term reveals is their pointwise mutual information over the entity's own
information, with a shrunken estimate of how often the term comes with the entity. Terms above a threshold are generalised,
and those that reveal nearly all of it removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import apart, cut, restored, small
from corpusloom.llm.spans import SPAN, found_sql, free_of, listed, listed_sql, matches, replaced, spans

#: Fixed by the contract. Runs that the first part could only leave are searched for from their first character, or from
#: the end of the match before; the rest does not backtrack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Share of an entity's information: generalised from GENERALISE on, removed from REMOVE on.
GENERALISE, REMOVE = 0.6, 0.9
#: How often a term comes with an entity is estimated as if PRIOR more documents had the term, and the entity at its usual rate.
PRIOR = 1.0
KINDS = ("email", "ip", "card", "phone")
#: A term: a run of letters.
_LETTERS = r"\p{L}++"
_FOUND = "array<struct<start:bigint,ord:int,kind:string,end:bigint,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = lambda n: F.when(n > 4, 2 * n - 9).otherwise(2 * n)
    worth = F.transform(each, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, n: a + n) % 10 == 0


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(12, 19) & luhn(digits)


def _stripped(part: Column) -> Column:
    """Digits without leading zeros, one at least."""
    return F.regexp_replace(part, "^0+(?=.)", "")


def _ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda part: (F.length(_stripped(part)) <= 3) & (F.left(_stripped(part), F.lit(3)).cast("int") <= 255))


def entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_row, doc_id, base (sorted spans) and, of rows with some, the spans of their terms; written to the shared folder."""
    text = F.col("_text")
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = out.withColumns({"_email": F.when(F.instr(text, "@") > 0, matches(text, EMAIL)), "_ip": matches(text, IP), "_card": matches(text, CARD), "_phone": F.when(F.instr(text, "+") > 0, matches(text, PHONE))})
    found = F.concat(
        spans("_email", "email", 0),
        F.filter(spans("_ip", "ip", 1), lambda x: _ip(x["value"])),
        F.filter(spans("_card", "card", 2), lambda x: _card(x["value"])),
        F.filter(spans("_phone", "phone", 3), lambda x: F.length(_digits(x["value"])).between(9, 15)),
    )
    out = out.select("doc_id", "_text", F.array_sort(found).cast(_FOUND).alias("base"))
    out = out.withColumn("_terms", F.when(F.size("base") > 0, matches(F.col("_text"), _LETTERS))).withColumn("_words", spans("_terms", "term", 4))
    words = F.coalesce(F.when(F.size("base") > 0, F.expr(free_of("_words", "base"))), F.expr(f"cast(array() as {_FOUND})")).cast(_FOUND)
    return cut(out.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "base", words.alias("words")), "entities")


def _share(both: Column, n_entity: Column, n_term: Column, total: int) -> Column:
    """The share of an entity's information that a term reveals; 0 for an entity that every document has."""
    usual = n_entity / F.lit(float(max(total, 1)))
    with_term = (both + PRIOR * usual) / (n_term + PRIOR)
    return F.when(usual < 1, 1 - F.log(with_term) / F.log(usual)).otherwise(F.lit(0.0))


def disclosures(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """_row, term and share of the terms with a share of at least GENERALISE: the largest of the row's entities.

    Document frequencies are of all documents. Entities of the same documents are rated as one, and a pair is counted only
    if its share would suffice if the rarer of the two never came alone.
    """
    total = found.count()
    some = found.where("size(base) > 0")
    holders = some.select("_row", F.explode(F.array_distinct(F.expr("transform(base, x -> x.value)"))).alias("entity"))
    same = ["n_entity", "first", "mixed"]
    groups = holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.min("_row").alias("first"), F.bit_xor(F.xxhash64("_row")).alias("mixed"))
    owned = cut(holders.join(small(cut(groups, "groups")), "entity").select("_row", *same).distinct(), "owned")
    lowered = lambda words: F.array_distinct(F.transform(words, F.lower))
    of_term = docs.select(F.explode(lowered(F.regexp_extract_all(text_col, F.lit(_LETTERS), F.lit(0)))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    terms = some.select("_row", F.explode(lowered(F.col("words.value"))).alias("term")).join(of_term, "term")
    most = _share(F.least("n_entity", "n_term"), F.col("n_entity"), F.col("n_term"), total)
    pairs = cut(terms.join(small(owned), "_row").where(most >= GENERALISE), "pairs")
    both = pairs.groupBy(*same, "term", "n_term").agg(F.count(F.lit(1)).alias("both"))
    leaks = both.withColumn("share", _share(F.col("both"), F.col("n_entity"), F.col("n_term"), total)).where(F.col("share") >= GENERALISE)
    leaks = cut(leaks.select(*same, "term", "share"), "leaks")
    return pairs.join(small(leaks), [*same, "term"]).groupBy("_row", "term").agg(F.max("share").alias("share"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, base (array of spans by start, then kind) and spans (base and the method's, of the
    kinds `generalise` and `remove`).

    A null text counts as empty. Terms are letters outside of base spans, compared in lower case. Repeated rows are searched
    each and count each; an empty table gives none. Only id and text are read.
    """
    found = entities(docs, id_col, text_col)
    leaks = cut(disclosures(docs, found, text_col), "disclosures")
    each = found.where("size(words) > 0").select("_row", F.explode("words").alias("w")).withColumn("term", F.lower("w.value"))
    worst = each.join(small(leaks), ["_row", "term"])
    remove = F.col("share") >= REMOVE
    kind = F.struct(F.col("w.start").alias("start"), F.when(remove, 5).otherwise(4).cast("int").alias("ord"), F.when(remove, "remove").otherwise("generalise").alias("kind"), F.col("w.end").alias("end"), F.col("w.value").alias("value"))
    added = worst.groupBy("_row").agg(F.collect_list(kind).alias("added"))
    out = found.join(added, "_row", "left")
    return out.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.expr(f"cast(array() as {_FOUND})")))).alias("spans"))


def personal_digests(searched: DataFrame) -> DataFrame:
    """The digest columns of find_personal's result."""
    n = lambda kind: F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
    return searched.select("doc_id", *map(n, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def sanitise(searched: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with entities replaced by their kind, as [EMAIL], revealing terms by [TERM] or nothing, for tables with unique ids.

    Of overlapping spans the one that starts first is replaced, and what the others have beyond it.
    """
    own, row_id, text = apart(docs, id_col, text_col)
    joined = own.join(searched.select("doc_id", "spans"), F.col(row_id).eqNullSafe(F.col("doc_id")), "left")
    word = "CASE x.kind WHEN 'remove' THEN '' WHEN 'generalise' THEN '[TERM]' ELSE concat('[', upper(x.kind), ']') END"
    return restored(joined.withColumn(text, F.when(F.size("spans") > 0, replaced(text, "spans", word)).otherwise(F.col(text))), docs)


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = "list_sum(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(x, i, 1)::INT ELSE 2 * substr(x, i, 1)::INT - CASE WHEN substr(x, i, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
#: The same with plain patterns, pairs of single entities and terms, and no bounds before the estimate.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
e AS ({found_sql("email", 0, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+")}), i AS ({found_sql("ip", 1, "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)")}),
c AS ({found_sql("card", 2, "[0-9](?:[ -]?[0-9])+")}), p AS ({found_sql("phone", 3, "[+][0-9][ ().0-9-]+[0-9]")}),
b AS (SELECT * FROM e UNION ALL SELECT * FROM i WHERE list_bool_and(list_transform(string_split(v, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(ltrim(x, '0') AS INT), 0) <= 255))
 UNION ALL SELECT * EXCLUDE x FROM (SELECT *, reverse({_DIGITS}) AS x FROM c) WHERE length(x) BETWEEN 12 AND 19 AND {_LUHN} UNION ALL SELECT * FROM p WHERE length({_DIGITS}) BETWEEN 9 AND 15),
l AS ({found_sql("term", 4, "[\\p{L}]+").replace("FROM d)", "FROM d WHERE rid IN (SELECT rid FROM b))")}),
w AS (SELECT *, lower(v) AS term FROM l WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.rid = l.rid AND b.start < l.stop AND l.start < b.stop)),
n AS (SELECT term, count(*) AS n_term FROM (SELECT DISTINCT rid, unnest(list_transform(regexp_extract_all(t, '[\p{{L}}]+'), lambda x: lower(x))) AS term FROM d) GROUP BY term),
h AS (SELECT DISTINCT rid, v AS entity FROM b), m AS (SELECT entity, count(*)::DOUBLE / (SELECT count(*) FROM d) AS usual FROM h GROUP BY entity),
q AS (SELECT entity, term, count(*) AS both_n FROM h JOIN (SELECT DISTINCT rid, term FROM w) USING (rid) GROUP BY entity, term),
r AS (SELECT entity, term, CASE WHEN usual < 1 THEN 1 - ln((both_n + {PRIOR} * usual) / (n_term + {PRIOR})) / ln(usual) ELSE 0 END AS share FROM q JOIN m USING (entity) JOIN n USING (term)),
x AS (SELECT rid, term, max(share) AS share FROM h JOIN r USING (entity) WHERE share >= {GENERALISE}::DOUBLE GROUP BY rid, term),
s AS (SELECT rid, ord, kind, start, stop FROM b UNION ALL SELECT w.rid, CASE WHEN share >= {REMOVE}::DOUBLE THEN 5 ELSE 4 END, CASE WHEN share >= {REMOVE}::DOUBLE THEN 'remove' ELSE 'generalise' END, start, stop FROM w JOIN x USING (rid, term))
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE ord = 0) AS n_email, count(*) FILTER (WHERE ord = 1) AS n_ip, count(*) FILTER (WHERE ord = 2) AS n_card, count(*) FILTER (WHERE ord = 3) AS n_phone,
 sha256({listed_sql("ord < 4")}) AS base_sha256, {listed_sql("ord IS NOT NULL")} AS spans FROM d LEFT JOIN s USING (rid) GROUP BY rid
"""
