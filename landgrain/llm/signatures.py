"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk where its low bits are zero, so
chunk ends depend on nearby text alone.  Each chunk gives one character.  A fingerprint
holds the block size (a power of two) with the signatures at that size and at twice
that size; fingerprints of equal or neighbouring block sizes are compared by the edit
distance of the signatures they have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut
from landgrain.llm.words import _POWERS, mix, parts

REACH = 7
LONGEST = 64
LEAST_LEVEL = 2
_WEIGHTS = np.random.default_rng(77).integers(1, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
_WEIGHTS[0] = 0
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of each byte and the six before it."""
    v = _WEIGHTS[data]
    out = v.copy()
    for j in range(1, REACH):
        out[j:] += v[:-j] * np.uint32(pow(0x9E3779B1, j, 1 << 32))
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    return out ^ (out >> np.uint32(13))


def _level(n: int) -> int:
    """The smallest level whose blocks cut n bytes into at most LONGEST chunks on average."""
    return max(LEAST_LEVEL, (max(n, 1) - 1).bit_length() - 6)


def signatures(texts: list[bytes]) -> list[str]:
    """`size:signature:signature at twice the size` of each text."""
    gap = b"\0" * REACH
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + REACH) - sizes
    levels = [_level(n) for n in sizes.tolist()]
    low = [max(LEAST_LEVEL, k - 3) for k in levels]
    mask = np.repeat(np.array([(1 << k) - 1 for k in low], np.uint32), sizes + REACH)
    rolled = _rolling(data)
    hit = np.flatnonzero((rolled & mask) == 0)
    depth = np.bitwise_count((rolled[hit] & (~rolled[hit] + np.uint32(1))) - np.uint32(1))
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    first, last = np.searchsorted(hit, starts, "left"), np.searchsorted(hit, starts + sizes, "left")
    out = []
    for k, n in enumerate(sizes.tolist()):
        here, deep = hit[first[k] : last[k]], depth[first[k] : last[k]]
        level = levels[k]
        while level > low[k] and np.count_nonzero(deep >= level) < LONGEST // 2:
            level -= 1
        begin = int(starts[k])
        both = [_signature(here[deep >= m] + 1, begin, begin + n, sums, down) for m in (level, level + 1)]
        out.append(f"{1 << level}:{both[0]}:{both[1]}")
    return out


def _signature(ends: np.ndarray, begin: int, stop: int, sums: np.ndarray, down: np.ndarray) -> str:
    """One character per chunk; what follows the 63rd chunk is one chunk."""
    edges = np.concatenate([[begin], ends[: LONGEST - 1], [stop]])
    if edges[-2] == stop:
        edges = edges[:-1]
    if len(edges) < 2:
        return ""
    a, b = edges[:-1], edges[1:]
    chunks = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
    return _ALPHABET[(chunks >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of `a`."""
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _alike(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) over the length of both.

    Signatures without a common run of seven characters, or of the shorter one's length,
    count as unrelated.
    """
    n = min(REACH, len(a), len(b))
    if not n or not {a[k : k + n] for k in range(len(a) - n + 1)} & {b[k : k + n] for k in range(len(b) - n + 1)}:
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints from 0 to 1; 1 if they are equal, 0 if their block sizes are not compatible."""
    if one == other:
        return 1.0
    (m, a1, a2), (n, b1, b2) = (x.split(":") for x in (one, other))
    m, n = int(m), int(n)
    if m == n:
        return max(_alike(a1, b1), _alike(a2, b2))
    if m == 2 * n:
        return _alike(a1, b2)
    if n == 2 * m:
        return _alike(a2, b1)
    return 0.0


def _edited(text: str, after: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIELDS = [x.split()[0] for x in _OUT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(ids: list, texts: list[str], afters: list[str]) -> list[list]:
    """The columns of `neighbours` for texts and the text after each."""
    encode = lambda x: x.encode("utf-8", "surrogatepass")
    edited = [encode(_edited(t, a)) for t, a in zip(texts, afters)]
    chain = all(a is t for a, t in zip(afters, texts[1:]))
    own = signatures([encode(t) for t in texts] + ([encode(afters[-1])] if chain else [encode(a) for a in afters]))
    new = signatures(edited)
    n = len(texts)
    mine, theirs = own[:n], own[1:] if chain else own[n:]
    return [ids, [len(t) for t in texts], [hashlib.sha256(e).hexdigest() for e in edited], mine, new, [likeness(a, b) for a, b in zip(mine, new)], [likeness(a, b) for a, b in zip(mine, theirs)]]


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", range_bytes: int = 16_000_000) -> DataFrame:
    """Fingerprint every text, its edited text and the likeness to both and to the next document.

    The next document is the one before in the order of keys, the last after the first;
    rows with one key are ordered by the XXH64 of their text, and null keys are the
    smallest.  The edited text ends with the beginning of the next one.  Null texts read
    as empty; a single row is its own neighbour; repeated rows are kept.

    Rows are cut into ranges of the order, whose size does not grow with the table.
    The first and last row of each range meet in a second, small step.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    order = [F.desc_nulls_last("doc_id"), F.desc("tie")]
    ranges = int(max(8, size // range_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held: tuple[list, list] = ([], [])
        first = True

        def edge(kind: int, doc, body: str) -> pa.RecordBatch:
            cols = [pa.array([kind], pa.int32()), pa.array([number], pa.int32()), pa.array([body], pa.string()), pa.array([doc], pa.int64())]
            return pa.RecordBatch.from_arrays([*cols, *(pa.array([None], t) for t in _TYPES[1:])], ["kind", "range_no", "body", *_FIELDS])

        for batch in batches:
            for a, b in parts(batch.column(1)):
                ids, texts = (held[k] + batch.column(k).slice(a, b - a).to_pylist() for k in (0, 1))
                if first:
                    yield edge(1, ids[0], texts[0])
                    first = False
                if len(texts) > 1:
                    cols = _compare(ids[:-1], texts[:-1], texts[1:])
                    n = len(texts) - 1
                    made = [pa.array([0] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array([None] * n, pa.string())]
                    yield pa.RecordBatch.from_arrays([*made, *(pa.array(c, t) for c, t in zip(cols, _TYPES))], ["kind", "range_no", "body", *_FIELDS])
                held = (ids[-1:], texts[-1:])
        if held[0]:
            yield edge(2, held[0][0], held[1][0])

    made = cut(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, f"kind int, range_no int, body string, {_OUT}"))
    filled = [r["range_no"] for r in made.where("kind = 1").select("range_no").orderBy("range_no").collect()]
    after = dict(zip(filled, filled[1:] + filled[:1]))
    turn = spark.createDataFrame(list(after.items()), "range_no int, next_no int") if filled else None
    inner = made.where("kind = 0").select(*_FIELDS)
    if turn is None:
        return inner
    heads = made.where("kind = 1").select(F.col("range_no").alias("next_no"), F.col("body").alias("after"))
    tails = made.where("kind = 2").select("range_no", "doc_id", "body").join(turn, "range_no").join(heads, "next_no").select("doc_id", "body", "after")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = _compare(*(batch.column(k).to_pylist() for k in range(3)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _FIELDS)

    return inner.unionByName(tails.mapInArrow(stitch, _OUT))


@query("op5_piecewise_fingerprints")
def op5(spark, sf):
    return neighbours(table(spark, sf, "documents"))
