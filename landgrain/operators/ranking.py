"""Positions in a total order, without sorting everything in one task.

A window over a whole table (or over one key that holds much of it) would run
in a single task.  Here the rows are range-partitioned by the whole order, ties
included, so that neither a frequent value nor a busy key fills a partition, and
sorted inside their partition.  A row's position is its place in the partition
plus the rows of the partitions before.  The number of partitions is
spark.sql.shuffle.partitions, which grows with the cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from landgrain.operators.spatial_join import durable


def _bounds(df: DataFrame, column: str, buckets: int) -> list:
    steps = [i / buckets for i in range(1, buckets)]
    return df.agg(F.percentile_approx(column, steps, 10_000)).first()[0] or []


def row_numbers(df: DataFrame, value: str, tie: str, keys: list[str] = (), name: str = "position", descending: bool = False) -> DataFrame:
    """1-based position of every row in the order (value, tie), within keys if given.

    `tie` must be unique per value; it orders as its type does, text by text.  Null
    values come last, and null keys are a group of their own.  The rows are written to
    the checkpoint folder once, because range bounds are sampled.
    """
    keys = list(keys)
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    order = [*[F.col(k).asc_nulls_last() for k in keys], v, F.col(tie).asc_nulls_last()]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = durable(ranged.withColumn("_id", F.monotonically_increasing_id()))
    # the id holds the partition above 33 bits and the place in it below
    placed = placed.select("*", F.shiftrightunsigned("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")).drop("_id")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per partition
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn("_row", F.col("_start") + F.col("_at"))
    if not keys:
        return numbered.withColumn(name, F.col("_row") + 1).select(*df.columns, name)
    firsts = numbered.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_row").alias("_first"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return numbered.join(firsts, same).withColumn(name, F.col("_row") - F.col("_first") + 1).select(*df.columns, name)


def ntile(df: DataFrame, value: str, tie: str, n: int, name: str) -> DataFrame:
    """Exact NTILE over the whole table; equal values are split by the tie column."""
    total = df.agg(F.count("*").alias("_total"))  # one row
    placed = row_numbers(df, value, tie, name="_pos").crossJoin(F.broadcast(total))
    size, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    big = extra * (size + 1)
    tile = F.when(F.col("_pos") <= big, F.ceil(F.col("_pos") / (size + 1))).otherwise(extra + F.ceil((F.col("_pos") - big) / size))
    return placed.withColumn(name, tile.cast("int")).drop("_pos", "_total")


def quantile_tile(df: DataFrame, value: str, n: int, name: str, accuracy: int = 10_000) -> DataFrame:
    """W5, approximate: tile edges from a quantile sketch; equal values share a tile."""
    edges = _bounds(df, value, n) if n > 1 else []
    tile = reduce(lambda acc, e: acc + F.when(F.col(value) > e, 1).otherwise(0), edges, F.lit(1))
    return df.withColumn(name, tile.cast("int"))


def batches(df: DataFrame, keys: list[str], order: str, tie: str, size: int, name: str = "batch") -> DataFrame:
    """floor(position / size) within each key, positions from 1."""
    return row_numbers(df, order, tie, keys, "_pos").withColumn(name, F.floor(F.col("_pos") / size).cast("long")).drop("_pos")


def average_rank(df: DataFrame, value: str, tie: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Ranks where equal values share the mean of their positions; a null value has a null rank and takes no position."""
    placed = row_numbers(df.where(F.col(value).isNotNull()), value, tie, name="_pos", descending=descending)
    shared = placed.groupBy(value).agg(((F.min("_pos") + F.max("_pos")) / 2).alias(name))
    return df.join(shared, value, "left").select(*df.columns, name)


def top_flag(df: DataFrame, value: str, tie: str, n: int, name: str = "is_top") -> DataFrame:
    """Is the average rank, largest first, within the top n; null values are not."""
    return average_rank(df, value, tie, "_rank").withColumn(name, F.coalesce(F.col("_rank") <= n, F.lit(False))).drop("_rank")


def best_rows(df: DataFrame, keys: list[str], order: list[Column], k: int = 1, name: str = "rank") -> DataFrame:
    """The first k rows per key; the rank filter limits groups before they are shuffled."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def ends(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The first and last n rows of a ranking."""
    top = df.orderBy(F.col(value).desc(), F.col(tie)).limit(n).withColumn("end", F.lit("head"))
    low = df.orderBy(F.col(value).asc(), F.col(tie).desc()).limit(n).withColumn("end", F.lit("tail"))
    return top.unionAll(low)
