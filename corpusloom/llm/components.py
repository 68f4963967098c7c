"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import cut, spent


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) of all nodes of the links (a, b), in alternating star rounds.

    In a large-star round each node's larger neighbours are linked to its smallest one, in a small-star round it and its
    smaller ones are. The number of rounds grows with the logarithm of the longest path. A star's centre is aggregated
    before the shuffle; its leaves stay rows. Nothing but the number of changes goes to the driver.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small_star = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut(small_star, "edges")
        same = now.count() == edges.count() and now.join(edges, ["u", "v"], "left_anti").isEmpty()
        spent(large, edges)
        edges = now
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
