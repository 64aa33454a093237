"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is parsed against the documents before it.  The reference is cut into
blocks by phrase hash, so that each phrase of a document meets the one block that can
hold it, and no document is compared with all blocks.

1. Anchors.  The smallest five-word hash in each window of 13 words is its anchor;
   equal windows have equal anchors.  Blocks of anchors report those that more than one
   document has.
2. Phrases.  Windows on such anchors go to blocks of phrases, where each is indexed by
   the place where it starts first: the smallest document, then the smallest position.
   A phrase that one group of documents holds twice keeps the first place in that group.
3. Parsing.  A document takes the reports on its windows and factors greedily: from a
   word it copies the longest run that continues in one reference.  Windows that lie
   across the boundary of two factors were looked up like all others, so every word
   that some copied window covers is removed.

Tasks send one row per pair of sender and block, with the hashes as packed arrays;
what a task has met twice it settles itself, so a common phrase costs a block one entry
per sender and not one per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrain.llm.book import query, table
from landgrain.llm.words import Words, grams, parts, split

WINDOW = 13
ANCHOR = 5
NO_DOC = np.iinfo(np.int64).max


def anchors(hashes: np.ndarray, of: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor position of each, hash of every gram): leftmost smallest gram of a window."""
    g = grams(hashes, anchor)
    n = max(0, len(hashes) - window + 1)
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - anchor + 1):
        here = g[j : j + n]
        less = here < best
        best[less] = here[less]
        at[less] = j
    whole = np.flatnonzero(of[:n] == of[window - 1 : window - 1 + n])
    return whole, at[whole] + whole, g


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document ids as numbers, and which of them are null."""
    null = np.asarray(column.is_null())
    return np.asarray(column.fill_null(0)).astype(np.int64), null


def _send(block: np.ndarray, columns: list[np.ndarray], by: list[np.ndarray]) -> Iterator[list]:
    """Rows (block, packed columns) of the entries of each block, in the order of `by`, which makes equal values adjacent."""
    order = np.lexsort([*by[::-1], block])
    block, columns = block[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
    for a, b in zip(starts, np.append(starts[1:], len(block))):
        yield [int(block[a]), *(c[a:b].tobytes() for c in columns)]


def _batch(rows: list[list], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(cols)], names)


def _table(rows: list[list], names: list[str]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, names)])


def _unpack(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column.to_pylist()] or [np.zeros(0, kind)])


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {'int' if k == 0 else 'binary'}" for k, n in enumerate(names))


ANCHOR_ROWS = ["block", "home", "doc", "anchor", "many"]
REPORT_ROWS = ["home", "doc", "what"]
PHRASE_ROWS = ["block", "home", "doc", "tag", "pos", "low", "high", "ref_doc", "ref_pos"]
COPY_ROWS = ["home", "row", "pos", "ref_doc", "ref_pos"]


REPEAT = np.iinfo(np.int64).min
"""Instead of a reference document: the phrase starts earlier in the same row."""


def _mixed(doc: np.ndarray) -> np.ndarray:
    return doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _tags(texts: pa.Array) -> np.ndarray:
    """A checksum of each text, which tells rows with one key apart."""
    return np.array([zlib.crc32(x.as_buffer()) if x.is_valid else 0 for x in texts.cast(pa.large_binary())], np.uint32)


def _firsts(lead: list[np.ndarray], rest: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by leading keys, then the rest; where each group of equal leading keys starts; its size."""
    order = np.lexsort([*rest[::-1], *lead[::-1]])
    lead = [k[order] for k in lead]
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in lead])
    starts = np.flatnonzero(new)
    return order, starts, np.diff(np.append(starts, len(order)))


def _windows(words: Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes = words.hashes()
    return (hashes, *anchors(hashes, of))


def _phrase_hashes(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each window: two hashes that are computed apart."""
    low = grams(hashes, WINDOW, 1)[starts]
    high = (grams(hashes, WINDOW, 2)[starts] >> np.uint64(32)).astype(np.uint32)
    return low, high


def _follow(row: np.ndarray, pos: np.ndarray, ref_doc: np.ndarray, ref_pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Give repeats inside a row the reference of their first place, drop them if it has none, and sort by place."""
    ids, number = np.unique(row, return_inverse=True)
    place, first = number.astype(np.int64) << 32 | pos, number.astype(np.int64) << 32 | ref_pos
    repeat = ref_doc == REPEAT
    order = np.argsort(place[~repeat], kind="stable")
    places, docs_there, pos_there = (x[~repeat][order] for x in (place, ref_doc, ref_pos))
    if repeat.any() and len(places):
        at = np.minimum(np.searchsorted(places, first[repeat]), len(places) - 1)
        hit = places[at] == first[repeat]
        places = np.concatenate([places, place[repeat][hit]])
        docs_there, pos_there = np.concatenate([docs_there, docs_there[at[hit]]]), np.concatenate([pos_there, pos_there[at[hit]]])
        order = np.argsort(places, kind="stable")
        places, docs_there, pos_there = places[order], docs_there[order], pos_there[order]
    return ids[places >> 32] if len(places) else ids[:0], places & 0xFFFFFFFF, docs_there, pos_there


def parse(n_words: int, pos: np.ndarray, ref_doc: np.ndarray, ref_pos: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Greedy factors of one document and the words that copied windows cover.

    `pos` are the starts of copied windows, ascending, with the place of their first
    occurrence.  A factor (start, length, ref_doc, ref_pos) runs as long as the next
    window continues in the same reference; the next factor starts where it ends, or at
    the next copied window that reaches beyond it.
    """
    covered = np.zeros(n_words + 1, np.int64)
    np.add.at(covered, pos, 1)
    np.add.at(covered, np.minimum(pos + window, n_words), -1)
    removed = np.cumsum(covered[:-1]) > 0
    factors = []
    if len(pos):
        joined = (pos[1:] == pos[:-1] + 1) & (ref_doc[1:] == ref_doc[:-1]) & (ref_pos[1:] == ref_pos[:-1] + 1)
        run_start = np.flatnonzero(np.concatenate([[True], ~joined]))
        run_end = np.append(run_start[1:], len(pos)) - 1
        reach = 0
        for a, b in zip(run_start.tolist(), run_end.tolist()):
            end = int(pos[b]) + window
            start = max(int(pos[a]), reach)
            if end > start:
                factors.append((start, end - start, int(ref_doc[a]), int(ref_pos[a]) + start - int(pos[a])))
                reach = end
    return removed, factors


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", home_bytes: int = 4_000_000, block_words: int = 4_000_000) -> DataFrame:
    """Every row with the words removed that a copied window of 13 words covers.

    A window is copied if its words also start in a document with a smaller key.  Added
    columns are n_words, n_removed, n_factors and kept (the words left, joined by one
    space); columns of those names are replaced.  Null and empty texts have no words.
    Rows with a null key are left as they are and are no reference.  Rows that share a
    key are no reference for each other.  All other
    columns pass through and repeated rows are kept.

    `home_bytes` of text and `block_words` of words set how many groups share the work,
    so a group stays of a size however large the table is.
    """
    added = ["n_words", "n_removed", "n_factors", "kept"]
    columns = [c for c in docs.columns if c not in added]
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    homes = max(64, size // home_bytes)
    blocks = max(64, size // (6 * block_words))
    home = F.pmod(F.xxhash64(key, F.length(text)), F.lit(homes)).cast("int")
    mark = "__home"
    while mark in docs.columns:
        mark += "_"
    sent = docs.select(*columns).withColumn(mark, home)
    k_key, k_text = columns.index(key), columns.index(text)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in parts(batch.column(1), 1 << 23):
                keep = np.flatnonzero(~_ids(batch.column(0).slice(a, b - a))[1]) + a
                rows = batch.take(pa.array(keep))
                ids, _ = _ids(rows.column(0))
                words = split(rows.column(1))
                of = words.of()
                _, at, g = _windows(words, of)[1:]
                at = np.unique(at)
                # Copies inside one document count once.
                doc, found, place = ids[of[at]], g[at], np.asarray(rows.column(2)).astype(np.int32)[of[at]]
                order = np.lexsort([place, doc, found])
                doc, found, place = doc[order], found[order], place[order]
                new = np.ones(len(order), bool)
                new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
                doc, found, place = doc[new], found[new], place[new]
                start = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
                sizes = np.diff(np.append(start, len(found)))
                many = np.zeros(len(found), np.uint8)
                if len(start):
                    several = np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)
                    many = np.repeat(several, sizes).astype(np.uint8)
                    # The first entry stands for the task; the rest of a settled group only needs a way home.
                    rest = many.astype(bool)
                    rest[start] = False
                    many[rest] = 2
                block = (found % np.uint64(blocks)).astype(np.int64)
                block = np.where(many == 2, (found + _mixed(doc)) % np.uint64(blocks), block).astype(np.int64)
                yield _batch(list(_send(block, [place, doc, found, many], [doc])), ANCHOR_ROWS)

    def common_anchors(rows: pa.Table) -> pa.Table:
        place, doc = _unpack(rows["home"], np.int32), _unpack(rows["doc"], np.int64)
        found, many = _unpack(rows["anchor"], np.uint64), _unpack(rows["many"], np.uint8)
        order = np.argsort(found, kind="stable")
        place, doc, found, many = place[order], doc[order], found[order], many[order]
        if len(found):
            start = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            several = (np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)) | (np.maximum.reduceat(many, start) > 0)
            keep = np.repeat(several, np.diff(np.append(start, len(found))))
            place, doc, found = place[keep], doc[keep], found[keep]
        return _table(list(_send(place, [doc, found], [doc])), REPORT_ROWS)

    def send_phrases(texts: pa.Table, reports: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        out: list[list] = []
        doc, what = _unpack(reports["doc"], np.int64), _unpack(reports["what"], np.uint64)
        if not len(doc) or not texts.num_rows:
            return _table(out, PHRASE_ROWS)
        marked = np.unique(what + _mixed(doc))
        column = texts.column(text).combine_chunks() if isinstance(texts.column(text), pa.ChunkedArray) else texts.column(text)
        ids, null = _ids(texts.column(key).combine_chunks())
        place = int(texts.column(mark)[0].as_py())
        words = split(column)
        of = words.of()
        hashes, starts, at, g = _windows(words, of)
        mine = g[at] + _mixed(ids[of[starts]])
        where = np.minimum(np.searchsorted(marked, mine), len(marked) - 1)
        use = (marked[where] == mine) & ~null[of[starts]]
        starts = starts[use]
        low, high = _phrase_hashes(hashes, starts)
        d, t = ids[of[starts]], _tags(column)[of[starts]]
        p = (starts - words.first[of[starts]]).astype(np.int32)
        # A phrase that this group holds twice is settled here: only its first place is looked up in the block.
        order, first, sizes = _firsts([low, high], [d, t, p])
        d, t, p, low, high = d[order], t[order], p[order], low[order], high[order]
        lead_d, lead_p = np.repeat(d[first], sizes), np.repeat(p[first], sizes)
        again = np.ones(len(order), bool)
        again[first] = False
        own = d == lead_d
        # A repeat inside one row points at its first place there and shares that place's fate.
        if len(order):
            turn = np.flatnonzero(again)
            new_doc = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])]) | ~again
            from_pos = p[np.maximum.accumulate(np.where(new_doc, np.arange(len(order)), 0))]
            repeat = np.zeros(len(order), bool)
            repeat[turn] = ~new_doc[turn]
        else:
            from_pos, repeat = p, again
        known = again & (repeat | ~own)
        block = np.where(known, (low + _mixed(d) + p.astype(np.uint64)) % np.uint64(blocks), low % np.uint64(blocks)).astype(np.int64)
        ref_d = np.where(repeat, REPEAT, np.where(known, lead_d, NO_DOC))
        ref_p = np.where(repeat, from_pos, np.where(known, lead_p, -1)).astype(np.int32)
        low, high = np.where(known, np.uint64(0), low), np.where(known, np.uint32(0), high)
        homes_ = np.full(len(order), place, np.int32)
        return _table(list(_send(block, [homes_, d, t, p, low, high, ref_d, ref_p], [d, t, p])), PHRASE_ROWS)

    def copied_phrases(rows: pa.Table) -> pa.Table:
        place, d, t, p = _unpack(rows["home"], np.int32), _unpack(rows["doc"], np.int64), _unpack(rows["tag"], np.uint32), _unpack(rows["pos"], np.int32)
        low, high = _unpack(rows["low"], np.uint64), _unpack(rows["high"], np.uint32)
        ref_d, ref_p = _unpack(rows["ref_doc"], np.int64), _unpack(rows["ref_pos"], np.int32)
        known = ref_p >= 0
        row = _mixed(d) + t
        out = [x[known] for x in (place, row, p, ref_d, ref_p)]
        place, d, t, p, row, low, high = (x[~known] for x in (place, d, t, p, row, low, high))
        order, first, sizes = _firsts([low, high], [d, t, p])
        place, d, p, row = place[order], d[order], p[order], row[order]
        lead_d, lead_p = np.repeat(d[first], sizes), np.repeat(p[first], sizes)
        later = d > lead_d
        out = [np.concatenate([x, y[later]]) for x, y in zip(out, (place, row, p, lead_d, lead_p))]
        return _table(list(_send(out[0], out[1:], [out[1], out[2]])), COPY_ROWS)

    result = docs.select(*columns).withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_factors": F.lit(0).cast("long"), "kept": F.lit("")})
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in result.schema])

    def take_out(texts: pa.Table, copies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_batches([], _arrow_schema(texts, columns))
        row, pos = _unpack(copies["row"], np.uint64), _unpack(copies["pos"], np.int32)
        ref_doc, ref_pos = _unpack(copies["ref_doc"], np.int64), _unpack(copies["ref_pos"], np.int32)
        row, pos, ref_doc, ref_pos = _follow(row, pos, ref_doc, ref_pos)
        ids, null = _ids(texts.column(key).combine_chunks())
        mine = _mixed(ids) + _tags(texts.column(text).combine_chunks())
        left, right = np.searchsorted(row, mine, "left"), np.searchsorted(row, mine, "right")
        totals: list[list] = [[], [], [], []]
        for k, body in enumerate(texts.column(text).to_pylist()):
            words = (body or "").encode("utf-8", "surrogatepass").split()
            a, b = (int(left[k]), int(right[k])) if not null[k] else (0, 0)
            at, rd, rp = pos[a:b], ref_doc[a:b], ref_pos[a:b]
            if len(at) > 1:
                new = np.concatenate([[True], at[1:] != at[:-1]])
                at, rd, rp = at[new], rd[new], rp[new]
            inside = at + WINDOW <= len(words)
            removed, factors = parse(len(words), at[inside], rd[inside], rp[inside])
            n = int(removed.sum())
            if n:
                words = [w for w, gone in zip(words, removed.tolist()) if not gone]
            for held, value in zip(totals, (n + len(words), n, len(factors), b" ".join(words).decode("utf-8", "surrogatepass"))):
                held.append(value)
        extra = [pa.array(x, pa.int64()) for x in totals[:3]] + [pa.array(totals[3], pa.string())]
        return pa.Table.from_arrays([*(texts.column(c) for c in columns), *extra], [*columns, *added])

    def _arrow_schema(texts: pa.Table, names: list[str]) -> pa.Schema:
        return pa.schema([texts.schema.field(c) for c in names] + [pa.field(c, pa.int64()) for c in added[:3]] + [pa.field("kept", pa.string())])

    found = sent.select(F.col(columns[k_key]), F.col(columns[k_text]), mark).mapInArrow(send_anchors, _schema(ANCHOR_ROWS))
    reports = found.groupBy("block").applyInArrow(common_anchors, _schema(REPORT_ROWS))
    phrases = sent.groupBy(mark).cogroup(reports.groupBy("home")).applyInArrow(send_phrases, _schema(PHRASE_ROWS))
    copies = phrases.groupBy("block").applyInArrow(copied_phrases, _schema(COPY_ROWS))
    return sent.groupBy(mark).cogroup(copies.groupBy("home")).applyInArrow(take_out, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages taken out of their texts; untouched texts stay as they are."""
    kept = remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    out = kept.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _check_sql(window: int = WINDOW) -> str:
    run = ", ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, window))])
    return rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        t AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM d),
        v AS (SELECT doc_id, i, concat_ws(' ', {run}) AS phrase FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY i + {window - 1} <= n),
        f AS (SELECT phrase, min(doc_id) AS owner FROM v GROUP BY 1),
        c AS (SELECT DISTINCT v.doc_id, v.i + j AS i FROM v JOIN f ON v.phrase = f.phrase AND f.owner < v.doc_id, range({window}) r(j)),
        k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM t ANTI JOIN c ON t.doc_id = c.doc_id AND t.i = c.i GROUP BY 1)
        SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""


@query("op3_relative_lz", _check_sql())
def op3(spark, sf):
    found = remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
