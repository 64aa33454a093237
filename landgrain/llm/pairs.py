"""Near-duplicate documents by SimHash and pivot distance tables.

Fingerprints are spread over blocks of six bit ranges: two of them that differ in at
most three bits agree in three whole ranges, so they meet in one of twenty blocks.
Inside a block a table of Hamming distances to reference fingerprints discards every
pair that differs by more than three in some coordinate, since that difference never
exceeds the pair's own distance; the rest is verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.components import components
from landgrain.llm.spaces import cut
from landgrain.llm.words import parts

SHINGLE = 3
RADIUS = 3
RANGES = [11, 11, 11, 11, 10, 10]
PIVOTS = 16
SLICE = 256
"""Fingerprints of a crowded block that are compared together."""


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the unsigned 64-bit hashes."""
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of every run of n words, A-Z lower-cased; of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[n - 1 :].tolist())), np.uint64, len(starts))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the SimHash of every whole text as a signed long; 0 for null and empty texts."""
    schema = docs.select(F.col(key).alias("key"), F.lit(0).cast("long").alias("fp")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in parts(batch.column(1)):
                found = [fingerprint(shingle_hashes(t)) for t in batch.column(1).slice(a, b - a).to_pylist()]
                signed = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(signed)], ["key", "fp"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(count, schema)


def _masks() -> list[int]:
    """The bits that two fingerprints share in each of the twenty blocks."""
    at, ranges = 0, []
    for n in RANGES:
        ranges.append(((1 << n) - 1) << at)
        at += n
    return [a | b | c for a, b, c in combinations(ranges, len(RANGES) - RADIUS)]


def _pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distance_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def near_in_runs(run: np.ndarray, fps: np.ndarray, pivots: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all pairs of one run within the radius; equal runs are adjacent.

    Pairs are met by their distance in position.  A pair survives one pivot after the
    other, and only pairs that survive all are compared.
    """
    table = distance_table(fps, pivots)
    first, second = [], []
    alive = np.arange(len(run))
    d = 1
    while True:
        alive = alive[alive + d < len(run)]
        alive = alive[run[alive] == run[alive + d]]
        if not len(alive):
            break
        a = alive
        for k in range(table.shape[1]):
            a = a[np.abs(table[a, k] - table[a + d, k]) <= radius]
        a = a[np.bitwise_count(fps[a] ^ fps[a + d]) <= radius]
        first.append(a)
        second.append(a + d)
        d += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(first or [none]), np.concatenate(second or [none])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position joined to each of n positions by the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def links(prints: DataFrame) -> DataFrame:
    """Links (u, v) that join the nodes of near fingerprints; `prints` has fp and node, each fp once.

    All pairs of a block are compared, but a block reports only a spanning forest of its
    near pairs, which keeps every component whole.  Crowded blocks are cut into slices
    that meet two by two.
    """
    blocks = F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for k, m in enumerate(_masks())]))
    spread = prints.select("fp", "node", blocks.alias("block"))
    crowds = spread.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").select("block", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    here = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    met = (
        spread.join(crowds, "block")
        .select("fp", "node", "block", here.alias("here"), other.alias("other"))
        .select("fp", "node", "block", F.least("here", "other").alias("i"), F.greatest("here", "other").alias("j"))
        .select("fp", "node", F.xxhash64("block", "i", "j").alias("run"))
    )
    pivots = _pivots()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _then_none(batches):
            now = None if batch is None else [np.asarray(batch.column(k)) for k in range(3)]
            held = now if rest is None else rest if now is None else [np.concatenate([x, y]) for x, y in zip(rest, now)]
            if held is None or not len(held[2]):
                continue
            fps, nodes, run = held
            stop = len(run) if batch is None else int(np.searchsorted(run, run[-1], "left"))
            rest = [x[stop:] for x in held]
            if not stop:
                continue
            fps, nodes, run = fps[:stop].view(np.uint64), nodes[:stop], run[:stop]
            root = forest(stop, *near_in_runs(run, fps, pivots))
            child = np.flatnonzero(root != np.arange(stop))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(nodes[root[child]])], ["u", "v"])

    return met.repartition("run").sortWithinPartitions("run").mapInArrow(compare, "u long, v long")


def _then_none(items: Iterator) -> Iterator:
    yield from items
    yield None


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) for every row.

    Equal fingerprints and those within three bits are linked, and the component id is the
    smallest key that links reach.  Empty and null texts have fingerprint zero and are
    linked like others.  Null keys name no component; a fingerprint that only rows
    with null keys have makes no links, and its component is null.  Repeated rows are kept.
    """
    rows = cut(fingerprints(docs, key, text))
    prints = cut(rows.where("key IS NOT NULL").groupBy("fp").agg(F.min("key").cast("long").alias("node")))
    roots = components(links(prints))
    named = prints.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return rows.join(named, "fp", "left").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose doc_id is the smallest of their component; rows without a doc_id stay."""
    found = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))


@query("op2_simhash_components")
def op2(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))
