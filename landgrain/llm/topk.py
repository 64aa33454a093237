"""Exact top-k inner products over norm-sorted blocks.

Candidates are processed by descending length.  Vectors are rotated by the singular
vectors of a sample, so that the first coordinates carry most of the product; the
Cauchy-Schwarz bound of the rest discards most pairs after a partial sum, and a query
is done with a block as soon as the lengths alone cannot reach its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut

SAMPLE = 2048
"""Longest vectors that give the rotation and the first thresholds: a fixed number, of any table."""

HEAD = 16
TILE = 512
_INT = "vec_id long, vector binary, norm double"


def quantise(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, vector, norm) with components floor(scale * x) as packed 64-bit integers.

    Null vectors and keys, and vectors with a null or non-finite component, take no part.  A finite
    component of 2**62 or more after scaling raises an error: its scores need not fit 64 bits.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k is None or not v.is_valid or v.values.null_count:
                    continue
                x = np.floor(np.asarray(v.values).astype(np.float64) * scale)
                if not np.isfinite(np.asarray(v.values).astype(np.float64)).all():
                    continue
                if not (np.abs(x) < 2.0**62).all():
                    raise ValueError(f"vector {k} has components beyond 64-bit scores")
                out[0].append(k)
                out[1].append(x.astype("<i8").tobytes())
                out[2].append(float(np.sqrt(x @ x)))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.float64())], ["vec_id", "vector", "norm"])

    return vectors.select(F.col(key).cast("long"), F.col(column)).mapInArrow(pack, _INT)


def _matrix(packed: list[bytes], dims: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled with zeros."""
    out = np.zeros((len(packed), dims), np.int64)
    for k, x in enumerate(packed):
        v = np.frombuffer(x, "<i8")
        out[k, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles where no sum can pass 2**53, in whole numbers of any size where it can pass 2**63."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2.0**62:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if exact.size and max(abs(exact.max()), abs(exact.min())) >= 1 << 63:
        raise OverflowError("a score doesn't fit 64 bits")
    return exact.astype(np.int64)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, rotation: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, row position, score) of at least the k best rows of each query that reach its floor.

    Rows come by descending length.  No row of the query's own id counts.  Bounds carry
    a margin for rounding; scores are exact.
    """
    rotated_q, rotated_v = queries @ rotation, rows @ rotation
    norm_q, norm_v = np.sqrt((rotated_q**2).sum(axis=1)), np.sqrt((rotated_v**2).sum(axis=1))
    rest_q, rest_v = (np.sqrt(np.maximum(0, (x[:, HEAD:] ** 2).sum(axis=1))) for x in (rotated_q, rotated_v))
    need = floor.astype(np.float64).copy()
    top = np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(rows), TILE):
        b = min(a + TILE, len(rows))
        longest = norm_v[a:].max()
        active = np.flatnonzero(norm_q * longest * (1 + 1e-9) + 1 >= need)
        if not len(active):
            break
        bound = rotated_q[active, :HEAD] @ rotated_v[a:b, :HEAD].T + np.outer(rest_q[active], rest_v[a:b])
        margin = norm_q[active, None] * norm_v[None, a:b] * 1e-9 + 1
        keep = (bound + margin >= need[active, None]) & (query_ids[active, None] != ids[None, a:b])
        some_q, some_v = np.flatnonzero(keep.any(axis=1)), np.flatnonzero(keep.any(axis=0))
        if not len(some_q):
            continue
        scores = _products(queries[active[some_q]], rows[a + some_v])
        kept = keep[np.ix_(some_q, some_v)]
        qs, vs = np.nonzero(kept & (scores >= need[active[some_q], None]))
        found.append((active[some_q[qs]], a + some_v[vs], scores[qs, vs]))
        merged = np.concatenate([top[active[some_q]], np.where(kept, scores, -np.inf)], axis=1)
        top[active[some_q]] = -np.partition(-merged, k - 1, axis=1)[:, :k]
        need = np.maximum(need, top[:, k - 1])
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    q, v, s = (np.concatenate(x) for x in zip(*found))
    kept = s >= need[q]
    q, v, s = q[kept], v[kept], s[kept]
    order = np.lexsort((ids[v], -s, q))
    q, v, s = q[order], v[order], s[order]
    starts = np.searchsorted(q, q, "left")
    kept = np.arange(len(q)) - starts < k
    return q[kept], v[kept], s[kept]


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 8192, query_block: int = 1024) -> DataFrame:
    """The k highest inner products of each query with all rows but its own: (query_id, rank, vec_id, score).

    Both inputs come from `quantise`.  Vectors of different length are compared as if the
    shorter one went on with zeros.  Fewer rows than k give all of them; ties go to the
    smaller vec_id.  Rows that repeat a vec_id are candidates of their own, and a query that
    is repeated is answered once per distinct vector.  No queries or no rows give an
    empty table.

    Blocks are ranges of length of about `block` rows; equal lengths are split by a
    hash of the row.  A block of queries meets only blocks whose longest vector can reach
    one of its thresholds.  Scores must fit 64 bits.
    """
    spark = vectors.sparkSession
    vectors, queries = cut(vectors), cut(queries.distinct())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.octet_length("vector")).alias("bytes")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(F.octet_length("vector")).alias("bytes")).first()
    if not stats["n"] or not asked["n"]:
        return empty
    dims = max(1, max(stats["bytes"], asked["bytes"]) // 8)

    longest = vectors.orderBy(F.desc("norm"), "vec_id").limit(SAMPLE).collect()
    sample, sample_ids = _matrix([r["vector"] for r in longest], dims).astype(np.float64), np.array([r["vec_id"] for r in longest])
    rotation = np.linalg.svd(sample.T @ sample / max(1.0, float(np.abs(sample).max()) ** 2))[0]

    ranges = max(1, -(-stats["n"] // block))
    edges = sorted(set(vectors.approxQuantile("norm", [i / ranges for i in range(1, ranges)], 0.1 / ranges)), reverse=True) if ranges > 1 else []
    number = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>"), lambda e: e >= F.col("norm")))
    placed = vectors.withColumn("range_no", number)
    sizes = {r["range_no"]: (r["n"], r["longest"]) for r in placed.groupBy("range_no").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).collect()}
    blocks, table_rows = [], []
    for range_no, (n, top) in sorted(sizes.items()):
        slices = -(-n // block)
        table_rows.append((range_no, len(blocks), slices))
        blocks += [(len(blocks) + s, top) for s in range(slices)]
    slicing = F.broadcast(spark.createDataFrame(table_rows, "range_no int, first int, slices int"))
    groups = max(1, -(-asked["n"] // query_block))

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A first floor for each query: its k-th best score among the longest vectors."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0))
            scores = _products(_matrix(batch.column(1).to_pylist(), dims), sample.astype(np.int64)).astype(np.float64)
            scores[ids[:, None] == sample_ids[None, :]] = -np.inf
            floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(ids), -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], ["vec_id", "vector", "norm", "floor"])

    floors = queries.mapInArrow(thresholds, _INT + ", floor double")
    reach = F.broadcast(spark.createDataFrame(blocks, "block int, longest double"))
    wanted = (
        floors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
        .join(reach, F.col("norm") * F.col("longest") * (1 + 1e-9) + 1 >= F.col("floor"))
        .select("block", "part", "vec_id", "vector", "floor")
    )
    needed = F.broadcast(spark.range(groups).select(F.col("id").cast("int").alias("part")))
    cells = (
        placed.join(slicing, "range_no")
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("slices")).cast("int"))
        .join(needed, F.lit(True))
        .select("block", "part", "vec_id", "vector", "norm")
    )

    def search(asked_: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("norm", "descending"), ("vec_id", "ascending")])
        out: tuple = ([], [], [])
        if asked_.num_rows and rows.num_rows:
            q_ids, ids = np.asarray(asked_["vec_id"]), np.asarray(rows["vec_id"])
            q, v, s = best(_matrix(asked_["vector"].to_pylist(), dims), q_ids, _matrix(rows["vector"].to_pylist(), dims), ids, rotation, np.asarray(asked_["floor"]), k)
            out = (q_ids[q], ids[v], s)
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), out)})

    found = wanted.groupBy("block", "part").cogroup(cells.groupBy("block", "part")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query(
    "op10_norm_sorted_topk",
    """WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
       s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
       SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op10(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return top_products(quantise(vectors), quantise(vectors.where("vec_id % 50 = 0")))
