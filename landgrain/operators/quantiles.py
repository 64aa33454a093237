"""Exact quantiles of groups of any size, by selection instead of sorting.

Values are counted once per group.  Every quantile asks for one or two ranks of its
group, and each rank has an interval of values that holds it: first that of the whole
group.  A round splits the intervals with many distinct values into equal buckets, counts
the buckets, and keeps the one with the rank, narrowed to its own smallest and largest
value.  An interval with few distinct values is put in order.  So no task ever holds the
values of a group, only some buckets or a bounded number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrain.operators.spatial_join import durable, small_enough

BUCKETS = 1024
"""Buckets of an interval in a round."""
DISTINCT = 10_000
"""Distinct values that are put in order in one task."""
BROADCAST_ROWS = 100_000
"""Ranks that are broadcast to the counted values; more are joined."""


def _same(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return out


def _held(counts: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """The counted values inside the interval of each rank of their group."""
    side = ranks.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    side = F.broadcast(side) if small_enough(ranks, BROADCAST_ROWS) else side
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    return counts.join(side, _same(keys) & inside).drop(*[f"_t_{k}" for k in keys])


def _with_rank(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each rank's interval, in order, whose counted values reach the rank."""
    w = Window.partitionBy(*keys, "_rank").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.col("_below") + F.sum("_n").over(w))
    return rows.where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))


def quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """(*keys, *names) with the linearly interpolated quantile of each name's share, as doubles.

    Null values don't count, and a group without values has no row; null keys are a group.
    Values are finite numbers.  Equal values share their ranks.
    """
    named = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    keyed = [F.col(k).alias(n) for k, n in zip(keys, named)] or [F.lit(0).alias("_k0")]
    counts = durable(df.where(F.col(value).isNotNull()).select(*keyed, F.col(value).cast("double").alias("_v")).groupBy(*named, "_v").agg(F.count("*").alias("_n")))
    stats = counts.groupBy(*named).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_distinct"))
    places = {p: F.lit(float(p)) * (F.col("_total") - 1) for p in wanted.values()}
    asked = F.array_distinct(F.concat(*[F.array(F.floor(x), F.ceil(x)) for x in places.values()]))
    sizes = durable(stats)
    ranks = durable(sizes.select(*named, F.explode(asked).alias("_rank"), F.lit(0).cast("long").alias("_below"), "_lo", "_hi", "_distinct"))
    while True:
        wide = ranks.where(F.col("_distinct") > DISTINCT)
        if wide.isEmpty():
            break
        place = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BUCKETS), F.lit(BUCKETS - 1))
        inside = _held(counts, wide, named).withColumn("_bucket", place)
        buckets = inside.groupBy(*named, "_rank", "_below", "_bucket").agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_distinct")
        )
        found = _with_rank(buckets, named, "_bucket").withColumn("_below", F.col("_upto") - F.col("_n"))
        ranks = durable(ranks.where(F.col("_distinct") <= DISTINCT).unionByName(found.select(ranks.columns)))
    exact = _with_rank(_held(counts, ranks, named), named, "_v").select(*named, "_rank", "_v")
    joined = sizes.select(*named, "_total").withColumnsRenamed({k: f"_t_{k}" for k in named}).join(exact, _same(named))
    out = []
    for name, p in wanted.items():
        low, high = (F.max(F.when(F.col("_rank") == end(places[p]), F.col("_v"))) for end in (F.floor, F.ceil))
        share = F.max(places[p]) - F.floor(F.max(places[p]))
        out.append((low + share * (high - low)).alias(name))
    rows = joined.groupBy(*named).agg(*out)
    return rows.select(*[F.col(n).alias(k) for k, n in zip(keys, named)], *wanted)


def with_quantiles(table: DataFrame, df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Aggregates per group with the quantiles of a value beside them; null where a group has no value."""
    found = quantiles(df, keys, value, wanted)
    if not keys:  # one row on each side
        return table.join(F.broadcast(found), F.lit(True), "left")
    return table.join(found.withColumnsRenamed({k: f"_t_{k}" for k in keys}), _same(keys), "left").drop(*[f"_t_{k}" for k in keys])
