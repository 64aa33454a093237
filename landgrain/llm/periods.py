"""Runs of periodic words, found in overlapping tiles of every octave of periods.

A run with period p is a stretch of matches: positions i whose word equals the word at
i + p.  For the periods of an octave, 2^k <= p < 2^(k+1), every long enough stretch covers a
point of the grid with step 2^k.

1. Every document is cut into overlapping tiles around the grid points of each octave.
   Points whose words don't repeat at any distance of the octave are not needed, and a
   tile without points is not sent.
2. A tile is solved alone: at each point the Z-function of the words to the right, and
   the Z-function of the mirrored words to the left, give how far the words match at each
   distance.  Blocks that are powers of a shorter block belong to the shorter period.
3. Fragments are shuffled by document and period and stitched where they touch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut
from landgrain.llm.words import grams, parts, split

LEAST = 6
REPEATS = 4
MARGIN = 24
"""Words that a grid point looks beyond two steps on either side."""
CHUNK = 1 << 18
"""Comparisons made at once when tiles are picked."""

SPAN = 4096
"""Words between the first and the last grid point of a tile, if sixteen steps are not more."""
TASK = 1 << 22
"""Bytes of tiles for one task."""
FLUSH = 1 << 22
"""Bytes of tiles that a task holds before it sends them."""
TEXT = 1 << 20
"""Bytes of text whose tiles are picked at once."""
ROWS = 64
"""Tiles that are lists of numbers at once."""


def least_length(period):
    """The shortest run of a period."""
    return np.maximum(LEAST, REPEATS * period)


def _width(octave: int) -> int:
    """Words that surely match after the first grid point of a stretch."""
    return 5 if octave < 2 else 9 if octave == 2 else 17


def grid_points(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(octave, documents, grid points) whose words repeat at a distance of the octave.

    `hashes` has the words of some documents, `first[d]:first[d + 1]` those of document d.
    """
    sizes = np.diff(first)
    most = int(sizes.max(initial=0))
    gram, width = np.zeros(0, np.uint64), 0
    octave = 0
    while least_length(1 << octave) <= most:
        step = 1 << octave
        if width != _width(octave):
            width = _width(octave)
            gram = grams(hashes, width)
        docs = np.flatnonzero(sizes >= least_length(step))
        counts = -(-sizes[docs] // step)
        of = np.repeat(docs, counts)
        at = (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
        here = first[of] + at
        # The last distance at which the gram still lies in the document, and that its length allows.
        far = np.minimum(sizes[of] // REPEATS, sizes[of] - width - at)
        keep = far >= step
        of, at, here, far = of[keep], at[keep], here[keep], far[keep]
        hit = np.zeros(len(of), np.uint64)
        rows = max(1, CHUNK // step)
        for a in range(0, len(of), rows):
            b = min(a + rows, len(of))
            distance = np.arange(step, min(2 * step, int(far[a:b].max()) + 1))
            other = here[a:b, None] + distance[None, :]
            same = gram[np.minimum(other, len(gram) - 1)] == gram[here[a:b], None]
            same &= distance[None, :] <= far[a:b, None]
            if step <= width:
                same = same * (np.uint64(1) << (distance - step).astype(np.uint64))
            hit[a:b] = np.bitwise_or.reduce(same.astype(np.uint64), axis=1)
        found = np.flatnonzero(hit)
        if len(found):
            of, at, hit = of[found], at[found], hit[found]
            if step <= width:
                kept = _thinned(of, at, hit, step, (reach(octave) - width) // step)
                of, at = of[kept], at[kept]
            yield octave, of, at
        octave += 1


def _thinned(of: np.ndarray, at: np.ndarray, hit: np.ndarray, step: int, every: int) -> np.ndarray:
    """Positions of the points to keep: every so many of neighbours that repeat at the same distances.

    Between such neighbours all words match, so one stretch holds them and a kept point reaches the others.
    """
    chained = np.append(False, (of[1:] == of[:-1]) & (at[1:] == at[:-1] + step) & (hit[1:] == hit[:-1]))
    place = np.arange(len(of))
    return np.flatnonzero((place - np.maximum.accumulate(np.where(chained, 0, place))) % every == 0)


def reach(octave: int) -> int:
    """Words that a grid point looks to either side."""
    return (2 << octave) + MARGIN


def z_function(x: list) -> list[int]:
    """For every position, how far the words from there equal those from the start."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and x[k] == x[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def solve(octave: int, grid: int, first: int, total: int, codes: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the stretches of matches around a grid point, as far as it reaches.

    `codes` are the words from `first` on, of a document with `total` words.  A stretch that
    ends within reach and is too short is left out; one that goes on is a fragment.
    """
    step, far = 1 << octave, reach(octave)
    low = max(0, grid - first - far)
    x, c = codes[low : grid - first + far + 2 * step], grid - first - low
    right = z_function(x[c:])
    before = x[:c][::-1]
    # Places of a mirrored word in `mirrored`: the pattern, a mark, then the words left of c + 2 * step.
    mirrored = x[: c + 2 * step - 1][::-1]
    z = z_function([*before, -1, *mirrored])
    out = []
    for p in range(step, min(2 * step, total // REPEATS + 1, len(right))):
        r = right[p]
        place = len(before) + 1 + len(mirrored) - (c + p)
        left = z[place] if place < len(z) and before else 0
        open_ = r >= far or (left >= far and grid - left > 0)
        r, left = min(r, far), min(left, far)
        if not (r or left) or (not open_ and r + left + p < least_length(p)):
            continue
        if any(p % q == 0 and right[q] >= p - q for q in range(1, p // 2 + 1)):
            continue
        out.append((p, grid - left, grid + r))
    return out


def tiles_of(octave: int, points: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(grid points, first word, end) of the tiles of one document: near points share a tile up to a fixed span."""
    far, ahead = reach(octave), reach(octave) + (2 << octave)
    span = max(SPAN, 16 << octave)
    starts = [0]
    for k in range(1, len(points)):
        if points[k] - points[k - 1] > far or points[k] - points[starts[-1]] > span:
            starts.append(k)
    for a, b in zip(starts, [*starts[1:], len(points)]):
        yield points[a:b], max(0, int(points[a]) - far), min(total, int(points[b - 1]) + ahead)


def keyed(docs: DataFrame, kind: str) -> DataFrame:
    """Heads and tiles of (name, text) rows; a head is one row per document, a tile has an octave.

    A document without tiles has no run: its words are hashed at once, as `plain_sha256`, and
    its text goes no further.  Keys number the rows, so documents that repeat a name stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in parts(batch.column(1), TEXT):
                rest = batch.slice(a, b - a)
                texts = rest.column(1)
                found = split(texts)
                sizes = np.diff(found.first).tolist()
                coded: dict[int, np.ndarray] = {}
                held = 0
                rows: list[dict] = []
                for octave, of, at in grid_points(found.hashes(), found.first):
                    for d in np.unique(of).tolist():
                        if d not in coded:
                            seen: dict[bytes, int] = {}
                            coded[d] = np.array([seen.setdefault(w, len(seen)) for w in texts[d].as_py().encode().split()], np.int32)
                        for points, lo, hi in tiles_of(octave, at[of == d], sizes[d]):
                            codes = coded[d][lo:hi].tobytes()
                            rows.append({"key": key + d, "octave": octave, "points": points.tolist(), "first": lo, "total": sizes[d], "codes": codes})
                            held += len(codes)
                            if held > FLUSH:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, held = [], 0
                names = rest.column(0).to_pylist()
                for d in range(b - a):
                    text = (texts[d].as_py() or "") if d in coded else None
                    sha = None if d in coded else hashlib.sha256(b" ".join((texts[d].as_py() or "").encode().split())).hexdigest()
                    rows.append({"key": key + d, "name": names[d], "n_words": sizes[d], "plain_sha256": sha, "text": text})
                yield pa.RecordBatch.from_pylist(rows, schema)
                key += b - a

    out = f"key long, name {kind}, n_words long, plain_sha256 string, text string, octave int, points array<long>, first long, total long, codes binary"
    schema = pa.schema([("key", pa.int64()), ("name", to_arrow_type(docs.schema["name"].dataType)), ("n_words", pa.int64()), ("plain_sha256", pa.string()), ("text", pa.string()), ("octave", pa.int32()), ("points", pa.list_(pa.int64())), ("first", pa.int64()), ("total", pa.int64()), ("codes", pa.binary())])
    return cut(docs.mapInArrow(run, out))


def solved(tiles: DataFrame) -> DataFrame:
    """(key, period, start, stop) of the stretches around every grid point of every tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            out: tuple[list, list, list, list] = ([], [], [], [])
            for key, octave, points, first, total, codes in zip(*(batch.column(k).to_pylist() for k in range(6))):
                x = np.frombuffer(codes, np.int32).tolist()
                for grid in points:
                    for found in solve(octave, grid, first, total, x):
                        for column, value in zip(out, (key, *found)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["key", "period", "start", "stop"])

    return tiles.select("key", "octave", "points", "first", "total", "codes").mapInArrow(run, "key long, period long, start long, stop long")


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period): fragments of one key and period that touch are one run, kept if long enough."""
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = fragments.distinct().withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("island", F.sum("new").over(order))
    runs = island.groupBy("key", "period", "island").agg(F.min("start").alias("start"), (F.max("stop") - F.min("start") + F.col("period")).alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), REPEATS * F.col("period"))).select("key", "start", "length", "period")


def runs_of(rows: DataFrame) -> DataFrame:
    """(key, start, length, period) of every run of the rows of `keyed`."""
    tiles = rows.where("octave IS NOT NULL")
    size = tiles.agg(F.sum(F.octet_length("codes") + 200 * F.size("points")).alias("n")).first()["n"] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A number of its own: solving is more work than the size of the tiles would tell.
    return stitched(solved(tiles.repartition(max(least, size // TASK), "key", "octave", "first")))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, period) of every run of every text.

    A run is a stretch of consecutive words whose smallest period repeats at least four
    times, six words long at least, and that no neighbouring word extends.  Words are
    `[^\\x20\\x09-\\x0D]+`.  A null or empty text has no run; rows that repeat give their
    runs again; a null key is a key; a table without rows gives none.  Texts are read whole.
    """
    rows = keyed(docs.select(F.col(key).alias("name"), F.col(text).alias("text")), docs.schema[key].dataType.simpleString())
    heads = rows.where("octave IS NULL AND text IS NOT NULL").select("key", "name")
    return runs_of(rows).join(heads, "key").select(F.col("name").alias(key), "start", "length", "period")


def collapsed(data: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run (start, length, period) covers after its first period, joined by spaces."""
    words = data.split()
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    drop = np.cumsum(gone) > 0
    return b" ".join(w for w, d in zip(words, drop.tolist()) if not d)


def reports(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_runs, the longest run, and digests of the runs and of the collapsed text.

    Of equally long runs the first counts, then the one with the smaller period.  Nulls and
    repeats are treated as `periodic_runs` does.  The runs of one document come together in
    one row; they are fewer than its words.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = keyed(docs.select(F.col(key).alias("name"), F.col(text).alias("text")), kind)
    runs = runs_of(rows).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    empty = hashlib.sha256(b"").hexdigest()
    plain = rows.where(F.col("plain_sha256").isNotNull()).select(
        "name", F.lit(0).cast("long").alias("n_runs"), *(F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")), F.lit(empty).alias("runs_sha256"), F.col("plain_sha256").alias("collapsed_sha256")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_, found in zip(batch.column(1), batch.column(2).to_pylist()):
                list_ = sorted((r["start"], r["length"], r["period"]) for r in found or ())
                top = min(list_, key=lambda r: (-r[1], r[0], r[2]), default=None)
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(list_, key=lambda r: (r[0], r[2])))
                out.append((len(list_), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(text_.as_py().encode(), list_)).hexdigest()))
            columns = [pa.array(x, t) for x, t in zip(zip(*out), [pa.int64()] * 5 + [pa.string()] * 2)] if out else [pa.array([], t) for t in [pa.int64()] * 5 + [pa.string()] * 2]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["name", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    with_runs = rows.where("octave IS NULL AND plain_sha256 IS NULL").select("key", "name", "text").join(runs, "key", "left").select("name", "text", "runs")
    found = with_runs.mapInArrow(run, f"name {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
    return plain.unionAll(found).withColumnRenamed("name", key)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """The documents with a periodic tail in those whose crc32(doc_id) is divisible by ten, as the query asks for."""

    def edit(key: int | None, text: str | None) -> str | None:
        h = 1 if key is None else zlib.crc32(str(key).encode())
        words = (text or "").encode().split() if h % 10 == 0 else []
        if not words:
            return text
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        block = words[a : a + p]
        tail = (block * (-(-(n - a) // p)))[: n - a]
        return b" ".join(words[:a] + tail).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edited = [edit(k, t.as_py()) for k, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(edited, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string")


@query("op13_stitched_runs")
def op13(spark, sf):
    return reports(repeated_tails(table(spark, sf, "documents")))
