"""Packing by optimal length buckets.

One aggregate makes the histogram of all lengths.  A dynamic program over it picks
the bucket boundaries with the least padding, and rows are numbered inside each
bucket to form batches of `budget // boundary` padded rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut

WORD = r"[^\x20\x09-\x0D]+"


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper ends of at most `buckets` length ranges with the least total padding.

    `lengths` are distinct and ascending.  Of equally good cuts the smaller one is
    taken.  The cost has the Monge property, so the best cut moves only upwards and
    each layer takes n log n steps.
    """
    n = len(lengths)
    if n == 0:
        return []
    size = np.asarray(lengths, np.float64)
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, np.float64))])
    tokens = np.concatenate([[0.0], np.cumsum(size * np.asarray(counts, np.float64))])

    def cost(cuts: np.ndarray, j: int) -> np.ndarray:
        return size[j] * (rows[j + 1] - rows[cuts]) - (tokens[j + 1] - tokens[cuts])

    layers = min(buckets, n)
    best = np.array([cost(np.array([0]), j)[0] for j in range(n)])
    came: list[np.ndarray] = []
    for layer in range(1, layers):
        now, cut_at = np.full(n, np.inf), np.zeros(n, np.int64)
        todo = [(layer, n - 1, layer, n - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            cuts = np.arange(first, min(j, last) + 1)
            total = best[cuts - 1] + cost(cuts, j)
            k = int(np.argmin(total))
            now[j], cut_at[j] = total[k], cuts[k]
            todo += [(lo, j - 1, first, int(cuts[k])), (j + 1, hi, int(cuts[k]), last)]
        best = now
        came.append(cut_at)
    ends, j = [n - 1], n - 1
    for cut_at in reversed(came):
        j = int(cut_at[j]) - 1
        ends.append(j)
    return [int(lengths[j]) for j in reversed(ends)]


def pack(rows: DataFrame, length: str = "n_tokens", key: str = "doc_id", buckets: int = 8, budget: int = 8192, per_task: int = 20_000) -> DataFrame:
    """Bucket, batch and slot of every row: (key, length, bucket, padded, batch, slot).

    Rows of a bucket are shuffled by the MD5 of their key, then cut into batches of
    `budget // padded` rows, one at least.  A null length counts as 0.  Repeated rows
    and null keys are kept, each in a slot of its own; an empty table gives no rows.
    The histogram that reaches the driver has one row per distinct length.
    """
    sized = rows.select(F.col(key).alias("key"), F.coalesce(F.col(length).cast("long"), F.lit(0)).alias("len"))
    sized = cut(sized.groupBy("key", "len").agg(F.count("*").alias("copies")))
    hist = sized.groupBy("len").agg(F.sum("copies").alias("n")).orderBy("len").collect()
    ends = boundaries([r["len"] for r in hist], [r["n"] for r in hist], buckets) or [0]
    digits = 2
    while sum(r["n"] for r in hist) > per_task * 16**digits / 16:
        digits += 1

    upper = F.array(*[F.lit(e).cast("long") for e in ends])
    placed = (
        sized.withColumn("bucket", F.size(F.filter(upper, lambda e: e < F.col("len"))))
        .withColumn("padded", F.element_at(upper, F.col("bucket") + 1))
        .withColumn("digest", F.md5(F.coalesce(F.col("key").cast("string"), F.lit(""))))
        .withColumn("part", F.substring("digest", 1, digits))
    )
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket", "part").agg(F.sum("copies").alias("n")).select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "part").orderBy("digest", "key", "len").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("padded")))).cast("long")
    return (
        placed.join(offsets, ["bucket", "part"])
        .withColumn("first", rank)
        .withColumn("rank", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))
        .select(
            F.col("key").alias(key),
            F.col("len").alias(length),
            F.col("bucket").cast("long").alias("bucket"),
            "padded",
            F.floor(F.col("rank") / per_batch).cast("long").alias("batch"),
            (F.col("rank") % per_batch).cast("long").alias("slot"),
        )
    )


def pack_texts(docs: DataFrame, **how) -> DataFrame:
    """Pack documents by their number of words; a null text has none."""
    return pack(docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).alias("n_tokens")), **how)


def _check_sql(buckets: int = 8, budget: int = 8192) -> str:
    steps = ["d1 AS (SELECT j, size * rows - tokens AS cost, 0::BIGINT AS i FROM h)"]
    for k in range(2, buckets + 1):
        steps.append(
            f"""t{k} AS (SELECT h.j, c.j + 1 AS i, d.cost + h.size * (h.rows - c.rows) - (h.tokens - c.tokens) AS cost
                FROM h JOIN h c ON c.j < h.j JOIN d{k - 1} d ON d.j = c.j),
            d{k} AS (SELECT j, min(cost) AS cost, arg_min(i, cost * 1000000 + i) AS i FROM t{k} GROUP BY j)"""
        )
    least = "(SELECT least(%d, count(*)) FROM h)" % buckets
    back = [f"e{buckets} AS (SELECT max(j) AS j FROM h)"]
    for k in range(buckets - 1, 0, -1):
        back.append(f"e{k} AS (SELECT CASE WHEN {least} <= {k} THEN (SELECT max(j) FROM h) ELSE (SELECT d.i - 1 FROM d{k + 1} d JOIN e{k + 1} e ON d.j = e.j) END AS j)")
    ends = " UNION ".join(f"SELECT j FROM e{k}" for k in range(1, buckets + 1))
    return f"""WITH s AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
        g AS (SELECT n_tokens AS size, count(*) AS n FROM s GROUP BY 1),
        h AS (SELECT row_number() OVER (ORDER BY size) - 1 AS j, size, (sum(n) OVER (ORDER BY size))::BIGINT AS rows, (sum(n * size) OVER (ORDER BY size))::BIGINT AS tokens FROM g),
        {", ".join(steps)}, {", ".join(back)},
        b AS (SELECT row_number() OVER (ORDER BY j) - 1 AS bucket, size AS padded, coalesce(lag(size) OVER (ORDER BY j), -1) AS above FROM h WHERE j IN ({ends})),
        r AS (SELECT doc_id, n_tokens, bucket, padded, row_number() OVER (PARTITION BY bucket ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS k
              FROM s JOIN b ON n_tokens > above AND n_tokens <= padded)
        SELECT doc_id, n_tokens, bucket, padded, k // greatest(1, {budget} // greatest(1, padded)) AS batch, k % greatest(1, {budget} // greatest(1, padded)) AS slot FROM r"""


@query("op1_length_buckets", _check_sql())
def op1(spark, sf):
    return pack_texts(table(spark, sf, "documents"))
