"""Operator 3, mixing sources to target weights, with DataFrame functions only.

Words are counted per source, targets give each source a repetition rate, and every document comes floor(rate) times plus
once more with the rate's fraction as probability, drawn from a hash of its id and text. Each source draws with the one of
SEEDS seeds whose mix comes nearest its target: one aggregate has the sums of all seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import WORD, apart, cut, restored, small

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has so many half words for each word of the input (150 %), and takes at most CAP words for each word of a source.
HALVES, CAP = 3, 2
#: Sorted slices in which the sources are numbered.
SLICES = 32
#: Seeds that a source chooses from: the draws of a Lehmer generator modulo a prime, which starts at the document's hash.
SEEDS, PRIME, STEP = 64, (1 << 31) - 1, 48271
FACTORS = [pow(STEP, k, PRIME) for k in range(1, SEEDS + 1)]


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ticket(key: Column, text: Column, seed: str) -> Column:
    """A whole number from 1 to PRIME - 1 from the MD5 of id, text and seed: the same in every run and engine."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}:"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % F.lit(PRIME - 1) + 1


def coin(ticket: Column, factor: Column) -> Column:
    """A number in (0, 1): one draw of the generator."""
    return (ticket * factor) % F.lit(PRIME) / F.lit(float(PRIME))


def source_targets(sizes: DataFrame, weights=WEIGHTS, halves: int = HALVES, cap: int = CAP) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    sizes has source and size. Sources are ordered by code point with null last; they are numbered in sorted slices, whose
    counts are summed, so that no task needs all sources. Targets share halves / 2 of all words by weight; a source whose
    share is above cap times its size gets that cap, and the excess goes to the others by weight until none is above. Each
    round of this is one aggregate over the sources.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    slices = by_source.repartitionByRange(SLICES, F.col("source").asc_nulls_last()).withColumn("slice", F.spark_partition_id())
    in_slice = Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last())
    numbered = cut(slices.withColumn("place", F.row_number().over(in_slice) - 1), "sources")
    before = numbered.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    offsets = before.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") + F.col("offset"), F.lit(len(weights))) + 1).cast("int"))
    weighed = cut(numbered.join(F.broadcast(offsets), "slice").select("source", "source_size", weight.cast("long").alias("weight")), "weights")  # at most SLICES offsets
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * halves
    weights_in_all = weighed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    capped, rest = 0, weights_in_all
    while True:
        # above the cap: (total / 2 - capped) * weight / rest > cap * size, in whole numbers
        above = F.lit(total - 2 * capped).cast("decimal(38,0)") * F.col("weight") >= F.lit(2 * cap * rest).cast("decimal(38,0)") * F.col("source_size")
        now = weighed.where(above).agg(F.coalesce(F.sum("source_size"), F.lit(0)) * cap, F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (now[0], weights_in_all - now[1]) == (capped, rest):
            break
        capped, rest = now[0], weights_in_all - now[1]
        if not rest:
            above = F.lit(True)
            break
    share = F.lit((total - 2 * capped) / 2) * F.col("weight") / F.lit(float(max(rest, 1)))
    return weighed.select("source", "source_size", "weight", F.when(above, F.lit(float(cap)) * F.col("source_size")).otherwise(share).alias("target"))


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def _drawn(factor: Column) -> Column:
    """1 if the document is drawn once more than floor(rate) times, else 0."""
    return F.when(coin(F.col("ticket"), factor) < F.col("rate") - F.floor("rate"), 1).otherwise(0)


def chosen_seeds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with rate and factor: that of the seed with which the source's words come nearest its target, the first of equals.

    sizes has source, size and ticket. The sums of all seeds are made before the shuffle, SEEDS rows per task and source.
    """
    rated = targets.withColumn("rate", _rate()).drop("weight").withColumnRenamed("source", "_source")
    joined = sizes.join(small(rated), F.col("source").eqNullSafe(F.col("_source"))).where(F.col("rate") > F.floor("rate"))
    draws = joined.select("source", "rate", "source_size", "target", "size", "ticket", F.posexplode(F.array(*map(F.lit, FACTORS))).alias("seed", "factor"))
    words = F.first(F.floor("rate") * F.col("source_size")) + F.sum(F.col("size") * _drawn(F.col("factor").cast("long")))
    sums = draws.groupBy("source", "seed", "factor").agg(F.abs(words - F.first("target")).alias("off"))
    best = sums.groupBy("source").agg(F.min_by("factor", F.struct("off", "seed")).alias("factor")).withColumnRenamed("source", "_of")
    told = rated.join(small(cut(best, "best")), F.col("_source").eqNullSafe(F.col("_of")), "left")
    return told.select(F.col("_source").alias("source"), "source_size", "target", "rate", F.coalesce("factor", F.lit(FACTORS[0])).cast("long").alias("factor"))


def _sizes(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    row = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), ticket(F.col(id_col), F.col(text_col), seed).alias("ticket"))
    return cut(row, "sizes")


def plan_mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, source, size, ticket, source_size, target, rate, copies, taken.

    A null or wordless text has size 0; a null source is a source of its own, the last. Rows with one id and text share their
    draw, so reruns and repeated rows agree; rows with one id, or none, and different texts do not. A source without words has
    rate 0. An empty table gives an empty plan. Columns other than the three named are not read.
    """
    sizes = _sizes(docs, seed, id_col, text_col, source_col)
    seeds = chosen_seeds(sizes, source_targets(sizes)).withColumnRenamed("source", "_source")
    joined = sizes.join(small(seeds), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    copies = (F.floor("rate") + _drawn(F.col("factor"))).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("factor")


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: docs with each row repeated as planned, all its columns kept, whatever their names.

    Defined for the cases of plan_mix. The few rows of rates are joined to docs by source, so texts are not shuffled unless
    there are more than BROADCAST_ROWS sources.
    """
    sizes = _sizes(docs, seed, id_col, text_col, source_col)
    seeds = chosen_seeds(sizes, source_targets(sizes)).select("source", "rate", "factor")
    own, row_id, text, source = apart(docs, id_col, text_col, source_col)
    joined = own.withColumn("ticket", ticket(F.col(row_id), F.col(text), seed)).join(small(seeds), F.col(source).eqNullSafe(F.col("source")), "left")
    copies = (F.floor("rate") + _drawn(F.col("factor"))).cast("int")
    return restored(joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))), docs)


_WEIGHT = f"CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END"
#: The same in closed form: capped are the first sources by cap to weight, as long as the share of the rest is above.
SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
 ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix:' || md5(coalesce(text, ''))), 1, 12))::BIGINT % {PRIME - 1} + 1 AS ticket FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, {_WEIGHT}::BIGINT AS weight FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS k, sum(source_size) OVER () * {HALVES} AS total FROM s),
c AS (SELECT *, coalesce(sum(source_size * {CAP}) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
 sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM o),
f AS (SELECT *, (total - 2 * before) * weight >= 2 * {CAP} * rest * source_size AS above FROM c),
l AS (SELECT coalesce(sum(source_size * {CAP}) FILTER (WHERE above), 0) AS capped, greatest(coalesce(sum(weight) FILTER (WHERE NOT above), 0), 1) AS rest FROM f),
t AS (SELECT source, source_size, CASE WHEN above THEN {CAP}::DOUBLE * source_size ELSE (((total - 2 * l.capped)::DOUBLE / 2) * weight) / l.rest::DOUBLE END AS target FROM f, l),
r AS (SELECT doc_id, d.source, size, ticket, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT unnest({FACTORS}) AS factor, unnest(range({SEEDS})) AS seed),
g AS (SELECT source, seed, factor, any_value(floor(rate)) * any_value(source_size) + sum(CASE WHEN (ticket * factor) % {PRIME} / {float(PRIME)}::DOUBLE < rate - floor(rate) THEN size ELSE 0 END) - any_value(target) AS off
 FROM r, e GROUP BY source, seed, factor),
b AS (SELECT source, arg_min(factor, {{'off': abs(off), 'seed': seed}}) AS factor FROM g GROUP BY source)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN (ticket * factor) % {PRIME} / {float(PRIME)}::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
"""
