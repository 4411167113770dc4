"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import lookup
from cohortspark.shared import cut_lineage


def _starred(pairs: DataFrame, total: int, keep_centre: bool) -> DataFrame:
    """Link every ``v`` of a node ``u`` to the smallest node around; ``pairs`` holds (u, v)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")).withColumn("m", F.least("u", "m"))
    joined = lookup(pairs, least, ["u"], "degree", total, F.col("v"))
    out = joined.filter(F.col("v") > F.col("u")) if not keep_centre else joined
    linked = out.select(F.col("v").alias("b"), F.col("m").alias("a"))
    if keep_centre:
        linked = linked.union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return linked.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of the links ``a``, ``b``; unlinked nodes have no row.

    Each round shuffles the links that are left and is stored, so that a lost executor costs one round. Both steps
    only ever replace links, so the table never grows, and the rounds are logarithmic in the longest chain.
    """
    links = cut_lineage(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    while True:
        total, mark = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if total == 0 or (total, mark) == state:
            return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(links.select("a", "a").distinct())
        state = (total, mark)
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        large = cut_lineage(_starred(both, 2 * total, keep_centre=False))
        links = cut_lineage(_starred(large.select(F.col("b").alias("u"), F.col("a").alias("v")), total, keep_centre=True))
