"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.spaces import cut


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link that isn't the smallest of its component.

    `links` has long columns u and v; loops, repeats and nulls are left out.  Each round
    points all neighbours of a node, then all smaller neighbours, to the smallest one; the
    number of rounds grows with the logarithm of the nodes.  Hubs are summed before the
    shuffle and joined by skew-splitting joins, and no group is collected.
    """
    now = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        reached = _state(after)
        if reached == state:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now, state = after, reached
