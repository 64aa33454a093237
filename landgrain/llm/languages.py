"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams (one to three letters,
words padded by a boundary mark).  A text takes the language whose profile is nearest
by out-of-place distance: the sum over the text's n-grams of the difference in rank,
with a fixed penalty for n-grams the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut
from landgrain.llm.words import mix, parts

SIZE = 300
"""N-grams in a profile."""
TEXT = 1 << 20
"""Bytes of text counted at once: sorting its n-grams takes some hundred times that."""

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def count_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram id, count) of all n-grams, ordered by text.

    Letters are lower-cased and everything else is a boundary.  An n-gram lies inside
    one word and its two boundary marks; the mark alone is not one.  Ids are 60-bit
    hashes of the code points.
    """
    none = np.zeros(0, np.int64)
    lowered = [("" if t is None else t).lower() + "\0" for t in texts]
    flat = np.frombuffer(("\0" + "".join(lowered)).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[flat] = True
    alphabet = np.flatnonzero(seen & _letters())
    if not len(alphabet):
        return none, none, none
    number = np.zeros(0x110000, np.uint32)
    number[alphabet] = np.arange(1, len(alphabet) + 1)
    # A gram is three places in the alphabet: (x, 0, 0) for one letter, (x, 0, y + 1) for two, (x, y, z) for three.
    bits = int(len(alphabet) + 1).bit_length()
    kind = np.uint32 if 3 * bits + len(texts).bit_length() <= 32 else np.uint64
    c = number[flat].astype(kind)
    letter = c > 0
    of = np.repeat(np.arange(len(texts), dtype=kind) << kind(3 * bits), [len(t) for t in lowered])
    of = np.concatenate([of[:1], of])
    top = c << kind(2 * bits)
    two = letter[:-1] | letter[1:]
    keys = [(top + of)[letter], (top[:-1] + c[1:] + kind(1) + of[1:])[two]]
    if len(c) > 2:
        keys.append((top[:-2] + (c[1:-1] << kind(bits)) + c[2:] + of[1:-1])[letter[1:-1]])
    every = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    counts = np.diff(np.append(new, len(every)))
    codes = every[new].astype(np.uint64)
    b, low = np.uint64(bits), np.uint64((1 << bits) - 1)
    points = np.concatenate([[0], alphabet]).astype(np.uint64)
    x, y, z = (codes >> (b + b)) & low, (codes >> b) & low, codes & low
    pair = (y == 0) & (z > 0)
    z = points[np.where(pair, z - np.uint64(1), z)] + pair.astype(np.uint64) * np.uint64(1 << 21)
    ids = mix((points[x] << np.uint64(43)) + (points[y] << np.uint64(22)) + z) >> np.uint64(4)
    return (codes >> np.uint64(3 * bits)).astype(np.int64), ids.astype(np.int64), counts


def learn(labelled: DataFrame, text: str = "text", label: str = "lang", size: int = SIZE) -> dict[str, list[int]]:
    """The `size` most frequent n-grams of each label, over every row that has one.

    Counts are summed per task, then over tasks.  What reaches the driver is bounded by
    `size` times the number of labels.  Ties go to the smaller n-gram id.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, int]] = {}
        for batch in batches:
            column, labels = batch.column(0), np.asarray(batch.column(1).to_pylist(), object)
            for a, b in parts(column, TEXT):
                of, grams, counts = count_grams(column.slice(a, b - a).to_pylist())
                for lang in sorted(set(labels[a:b])):
                    mine = (labels[a:b] == lang)[of]
                    ids, back = np.unique(grams[mine], return_inverse=True)
                    total = np.bincount(back, counts[mine], len(ids)).astype(np.int64)
                    held = sums.setdefault(lang, {})
                    for g, n in zip(ids.tolist(), total.tolist()):
                        held[g] = held.get(g, 0) + n
        for lang, held in sums.items():
            for k in range(0, len(held), 50_000):
                items = list(held.items())[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(items)), pa.array([g for g, _ in items], pa.int64()), pa.array([n for _, n in items], pa.int64())], ["lang", "gram", "n"])

    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = cut(rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    best = [counts.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(size) for lang in langs]
    profiles: dict[str, list[int]] = {lang: [] for lang in langs}
    if best:
        union = best[0]
        for other in best[1:]:
            union = union.unionAll(other)
        for r in sorted(union.collect(), key=lambda r: (-r["n"], r["gram"])):
            profiles[r["lang"]].append(r["gram"])
    return profiles


class Ranker:
    """Out-of-place distances of many texts to every profile."""

    def __init__(self, profiles: dict[str, list[int]], size: int = SIZE):
        self.langs = sorted(profiles)
        self.size = size
        self.grams = np.unique(np.concatenate([np.asarray(p, np.int64) for p in profiles.values()])) if profiles else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            ids = np.searchsorted(self.grams, np.asarray(profiles[lang], np.int64))
            self.ranks[ids, k] = np.arange(len(ids))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; `und` and 0 without letters or without profiles.

        The score is 1 less the distance over the largest possible one, so it lies in
        0 to 1.  Ties go to the first language in the order of names.
        """
        out, score = ["und"] * len(texts), [0.0] * len(texts)
        of, grams, counts = count_grams(texts)
        if not self.langs or not len(of):
            return out, score
        order = np.lexsort((grams, -counts, of))
        of, grams = of[order], grams[order]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.append(starts, len(of))))
        kept = rank < self.size
        of, grams, rank = of[kept], grams[kept], rank[kept]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - rank[:, None]))
        total = np.add.reduceat(apart, starts, axis=0)
        sizes = np.diff(np.append(starts, len(of)))
        nearest = np.argmin(total, axis=1)
        for k, text in enumerate(of[starts].tolist()):
            out[text] = self.langs[nearest[k]]
            score[text] = float(1 - total[k, nearest[k]] / (self.size * sizes[k]))
        return out, score


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text") -> DataFrame:
    """Add lang_pred and score to every row; columns of those names are replaced.

    Null texts and texts without a letter are `und` with score 0, as is every text when
    there are no profiles.  Whole texts are counted; repeated rows are kept.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    ranker = Ranker(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(kept.index(text))
            for a, b in parts(column, TEXT):
                found, score = ranker.predict(column.slice(a, b - a).to_pylist())
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(predict, schema)


def held_out(key: str = "doc_id"):
    """True for the quarter of the rows that training leaves out; a null key is in training."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside the held-out quarter and predict every row."""
    profiles = learn(docs.where(~held_out()).select("text", "lang"))
    return identify(docs, profiles).withColumn("held_out", held_out())


@query("op7_rank_order_languages")
def op7(spark, sf):
    docs = table(spark, sf, "documents")
    profiles = learn(docs.where(~held_out()).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
