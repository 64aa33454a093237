"""Repair of conversation structure by integer weights.

A path through the rows of a conversation keeps, reroles or deletes each row and inserts
rows between them; its states are the last role kept.  The weight of a path is one
integer.  Its high digits are the cost.  Below them every row has two digits for the
letters of its edits (an insert and its own edit), filled up with zeros at the end, so that
of equally cheap paths the smaller number has the smaller audit: the letters before a row's
own edit are all inserts, which makes the rows' words free of prefixes.  The smallest sum
over the states decides everything.

Two inserts in a row lead back to the state before, or cost more than deleting the system
row that asks for them, so a row has one place for an insert, and so has the end.

Rows are sorted over ranges of (conversation, turn, role, text digest).  A conversation is
solved in blocks of bounded size, for every state it may start in; the blocks are then one
step each in the same kind of sum, with the rank of their audits as a digit.  A
conversation that lies in several partitions sends one such step per partition to the
driver, two rows per partition at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrain.llm.book import query, table
from landgrain.llm.spaces import cut

SPACES = " \t\n\r\x0b\x0c"
BLOCK = 256
"""Rows of one sum of weights."""
ROWS = 200_000
"""Rows of a partition."""

# Costs of edits: fixed by the task.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
"""First fault of a row."""
START, SYSTEM, USER, ASSISTANT = range(4)
"""State: nothing kept yet, or the role kept last."""
ENDS = (START, ASSISTANT)
LETTERS = "\0DIKR"
"""The digit of a letter is its place; letters and digits have the same order."""
_DIGIT = {c: k for k, c in enumerate(LETTERS)}
SLOT = 6
"""Bits of the two digits of a row."""


def _after(state: int, initial: int) -> int | None:
    """The state after a row whose role starts with s (0), u (1) or a (2); None if it may not stand there."""
    if initial == 1:
        return USER if state != USER else None
    if initial == 2:
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == 0 and state == START else None


def _added(state: int) -> int:
    """The state after the only role that may be inserted or given."""
    return ASSISTANT if state == USER else USER


def _word(letters: str) -> int:
    return (_DIGIT[letters[0]] << 3) + (_DIGIT[letters[1]] if len(letters) > 1 else 0)


def _steps(initial: int, fault: int) -> list[list[tuple[int, int, int]]]:
    """(next state, cost, word) of every edit of a row, by the state before."""
    out = []
    for state in range(4):
        moves = []
        for lead, at, cost in (("", state, 0), ("I", _added(state), INSERT)):
            moves.append((at, cost + DELETE, _word(lead + "D")))
            if fault in (SOUND, CUT_OFF):
                more = cost + (TRUNCATED if fault == CUT_OFF else 0)
                kept = _after(at, initial)
                if kept is not None:
                    moves.append((kept, more, _word(lead + "K")))
                moves.append((_added(at), more + REROLE, _word(lead + "R")))
        out.append(moves)
    return out


STEPS = [_steps(initial, fault) for initial in range(4) for fault in range(4)]
"""Edits of a row by its class, 4 * initial + fault."""
END = {state: 0 if state in ENDS else (INSERT << 3) + _DIGIT["I"] if state == USER else None for state in range(4)}
"""Cost and last digit of the end of a conversation; a lone system row cannot end one."""


def solve(classes: bytes, start: int) -> dict[int, int]:
    """The smallest weight of the rows of a block for each state it can end in."""
    shift = SLOT * len(classes)
    weights = {start: 0}
    for row, kind in enumerate(classes):
        place = shift - SLOT * (row + 1)
        after: dict[int, int] = {}
        for state, weight in weights.items():
            for to, cost, word in STEPS[kind][state]:
                w = weight + (cost << shift) + (word << place)
                if to not in after or w < after[to]:
                    after[to] = w
        weights = after
    return weights


def letters(weight: int, rows: int) -> list[str]:
    """The edits of every row of a block."""
    return [LETTERS[w >> 3] + (LETTERS[w & 7] if w & 7 else "") for w in (weight >> (SLOT * (rows - 1 - k)) & 63 for k in range(rows))]


Step = dict[tuple[int, int], tuple[int, int]]
"""Cost and audit rank of a block by the states before and after it; ranks order the audits of the block."""


def ranked(paths: dict[tuple[int, int], tuple[int, int]]) -> Step:
    """Replace audits (any comparable integers) by their ranks."""
    order = {a: k for k, a in enumerate(sorted({a for _, a in paths.values()}))}
    return {k: (cost, order[a]) for k, (cost, a) in paths.items()}


def block_step(classes: bytes, starts: tuple[int, ...]) -> Step:
    shift = SLOT * len(classes)
    low = (1 << shift) - 1
    return ranked({(s, e): (w >> shift, w & low) for s in starts for e, w in solve(classes, s).items()})


def chain(steps: list[Step], start: int) -> dict[int, tuple[int, list[int]]]:
    """By end state: the smallest weight of a list of steps, and the states between them, `start` first."""
    shift = 4 * len(steps)
    weights, back = {start: 0}, []
    for k, step in enumerate(steps):
        place = shift - 4 * (k + 1)
        after: dict[int, int] = {}
        via: dict[int, int] = {}
        for (s, e), (cost, rank) in step.items():
            if s in weights:
                w = weights[s] + (cost << shift) + (rank << place)
                if e not in after or w < after[e]:
                    after[e], via[e] = w, s
        weights = after
        back.append(via)
    out = {}
    for end, weight in weights.items():
        path = [end]
        for via in reversed(back):
            path.append(via[path[-1]])
        out[end] = (weight, path[::-1])
    return out


def joined(steps: list[Step], starts: tuple[int, ...]) -> Step:
    """Several steps as one."""
    shift = 4 * len(steps)
    low = (1 << shift) - 1
    return ranked({(s, e): (w >> shift, w & low) for s in starts for e, (w, _) in chain(steps, s).items()})


def finish(steps: list[Step], start: int = START) -> list[int]:
    """The states between the steps up to the end of a conversation, `start` first."""
    shift = 4 * len(steps)
    best = None
    for end, (weight, path) in chain(steps, start).items():
        if END[end] is not None:
            total = (((weight >> shift) + (END[end] >> 3)) << shift | weight & ((1 << shift) - 1)) << 3 | END[end] & 7
            if best is None or total < best[0]:
                best = total, path
    return best[1]


def _blocks(classes: bytes) -> list[bytes]:
    return [classes[k : k + BLOCK] for k in range(0, len(classes), BLOCK)]


def edits(classes: bytes, start: int = START, end: int | None = None) -> list[str]:
    """The edits of every row between two states; without `end` up to the end of the conversation, a last insert included."""
    parts = _blocks(classes)
    if end is None and start == START and len(parts) == 1:  # the usual case needs no ranks
        found = solve(classes, START)
        total = {e: (w + ((END[e] >> 3) << SLOT * len(classes))) << 3 | END[e] & 7 for e, w in found.items() if END[e] is not None}
        last = min(total, key=total.__getitem__)
        out = letters(found[last], len(classes))
    else:
        starts = tuple(range(4))
        steps = [block_step(p, (start,) if k == 0 else starts) for k, p in enumerate(parts)]
        path = finish(steps, start) if end is None else chain(steps, start)[end][1]
        last = path[-1]
        out = [x for p, s, e in zip(parts, path, path[1:]) for x in letters(solve(p, s)[e], len(p))]
    if end is None and END[last]:
        out[-1] += "I"
    return out


# -- rows --------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n, role, initial, fault) of the distinct rows; n counts equal ones.

    The first of equal roles and texts is the one with the smallest turn, nulls first.
    """
    body = F.rtrim("text", F.lit(SPACES))
    fault = F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(SOUND)
    light = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), fault.cast("int").alias("fault"))
    light = light.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.count("*").alias("n"))
    again = light.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("first"), F.count("*").alias("times"))
    again = again.where("times > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    seen = F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return light.join(again, same, "left").select(
        "conv_id", "turn", "role", "digest", "n", initial.cast("int").alias("initial"), F.when((F.col("fault") != BLANK) & seen, DUPLICATE).otherwise(F.col("fault")).cast("int").alias("fault")
    )


_KEYS = ["conv_id", "turn", "role", "digest"]


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    """A partition, whose rows `ROWS` bounds and which holds no texts."""
    return pa.concat_tables([_PLACED.empty_table(), *(pa.Table.from_batches([b]).cast(_PLACED) for b in batches)])


def _segments(t: pa.Table) -> list[tuple[int, int]]:
    """Row ranges of the conversations of a sorted partition."""
    ids = t["conv_id"].combine_chunks()
    null = np.asarray(ids.is_null())
    value = np.asarray(ids.fill_null(0))
    cuts = np.flatnonzero((value[1:] != value[:-1]) | (null[1:] != null[:-1])) + 1
    edges = [0, *cuts.tolist(), len(value)]
    return list(zip(edges, edges[1:]))


def _classes(t: pa.Table, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, source row and copy number of every row of a segment; copies after the first are duplicates."""
    part = t.slice(a, b - a)
    n, initial, fault = (part[c].to_numpy() for c in ("n", "initial", "fault"))
    source = np.repeat(np.arange(b - a), n)
    copy = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
    kinds = np.where((copy > 0) & (fault[source] != BLANK), DUPLICATE, fault[source])
    return (4 * initial[source] + kinds).astype(np.uint8), source, copy


def decisions(rows: DataFrame) -> DataFrame:
    """The edits of every row: conv_id, turn, role, digest, copy, letters, fault, and whether turn and roles follow.

    `rows` has conv_id (any whole number), turn, role and text.  Nulls in role and text read as one
    space; a null conv_id is a conversation of its own; null turns come first.  Rows of one turn
    are ordered by role, then by the SHA-256 of the text; equal rows are copies of each
    other, and copies after the first are duplicates.  `illegal` is set where the role may
    not follow the one before, `new_turn` where the turn is not null and new.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _text("role").alias("role"), _text("text").alias("text"))
    light = cut(marked(rows))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = light.repartitionByRange(max(least, light.count() // ROWS + 1), *_KEYS).sortWithinPartitions(*_KEYS)
    placed = cut(ranges.withColumn("part", F.spark_partition_id()))

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last conversation of a partition, as one step each."""
        t = _whole(batches)
        if not t.num_rows:
            return
        found = _segments(t)
        out = []
        for which, (a, b) in enumerate([found[0], found[-1]] if len(found) > 1 else found):
            classes = _classes(t, a, b)[0].tobytes()
            step = joined([block_step(p, (0, 1, 2, 3)) for p in _blocks(classes)], (0, 1, 2, 3))
            flat = [x for (s, e), (cost, rank) in sorted(step.items()) for x in (s, e, cost, rank)]
            out.append({"part": t["part"][0].as_py(), "which": which, "conv_id": t["conv_id"][a].as_py(), "step": flat, "initial": t["initial"][b - 1].as_py(), "turn": t["turn"][b - 1].as_py()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int32()), ("which", pa.int32()), ("conv_id", pa.int64()), ("step", pa.list_(pa.int64())), ("initial", pa.int32()), ("turn", pa.int64())]))

    # Two rows per partition: the only conversations that may go on elsewhere.
    ends = placed.mapInArrow(borders, "part int, which int, conv_id long, step array<long>, initial int, turn long").orderBy("part", "which").collect()
    given: dict[tuple[int, int], tuple] = {}  # by (partition, which): states before and after, initial and turn before
    k = 0
    while k < len(ends):
        stop = k + 1
        while stop < len(ends) and ends[stop]["conv_id"] == ends[k]["conv_id"]:
            stop += 1
        if stop - k > 1:
            group = ends[k:stop]
            path = finish([{(s, e): (c, r) for s, e, c, r in np.reshape(g["step"], (-1, 4)).tolist()} for g in group])
            for j, g in enumerate(group):
                before = group[j - 1] if j else None
                given[g["part"], g["which"]] = (path[j], path[j + 1] if j + 1 < len(group) else None, before["initial"] if before else None, before["turn"] if before else None)
        k = stop

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)
        if not t.num_rows:
            return
        part, found = t["part"][0].as_py(), _segments(t)
        for k, (a, b) in enumerate(found):
            which = 0 if k == 0 else 1 if k == len(found) - 1 else None
            start, end, last, turn = given.get((part, which), (START, None, None, None))
            classes, source, copy = _classes(t, a, b)
            done = edits(classes.tobytes(), start, end)
            role = classes >> 2
            before = np.append(3 if last is None else last, role[:-1])
            pair = 4 * before + role
            illegal = ~np.isin(pair, (1, 6, 9))  # su, ua, au
            if last is None:
                illegal[0] = False
            turns = t["turn"].slice(a, b - a).combine_chunks()
            null, value = np.asarray(turns.is_null())[source], np.asarray(turns.fill_null(0))[source]
            new = ~null & np.append(turn is None or value[0] != turn, (value[1:] != value[:-1]) | null[:-1])
            keys = t.select(_KEYS).slice(a, b - a).take(pa.array(source))
            for c, values in zip(("copy", "letters", "fault", "illegal", "new_turn"), (pa.array(copy.astype(np.int64)), pa.array(done), pa.array((classes & 3).astype(np.int32)), pa.array(illegal), pa.array(new))):
                keys = keys.append_column(c, values)
            yield from keys.combine_chunks().to_batches()

    return placed.mapInArrow(decide, _DECIDED)


_PLACED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("n", pa.int64()), ("initial", pa.int32()), ("fault", pa.int32()), ("part", pa.int32())])
_DECIDED = "conv_id long, turn long, role string, digest binary, copy long, letters string, fault int, illegal boolean, new_turn boolean"


def _together(rows: DataFrame, decided: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids, texts and edits of a conversation in one stream: a text comes right before the edits of its rows."""
    texts = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _text("role").alias("role"), _text("text").alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    nothing = {"turn": "long", "role": "string", "digest": "binary", "copy": "long", "letters": "string", "fault": "int", "illegal": "boolean", "new_turn": "boolean", "text": "string"}
    order = ["conv_id", "kind", *nothing]
    every = [
        ids.select(F.col("conv_id").cast("long"), F.lit(0).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in nothing.items())),
        texts.select("conv_id", F.lit(1).alias("kind"), *(F.col(c) if c in texts.columns else F.lit(None).cast(t).alias(c) for c, t in nothing.items())),
        decided.withColumn("kind", F.lit(1)).withColumn("text", F.lit(None).cast("string")).select(*order),
    ]
    one = every[0].unionAll(every[1]).unionAll(every[2])
    return one.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest", F.col("letters").isNotNull(), "copy")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, decided row or None, [(letter, role, text)]) of every row of the stream."""
    state, now, text, known = START, None, None, False
    for batch in batches:
        for r in batch.to_pylist():
            if not known or r["conv_id"] != now:
                state, now, known = START, r["conv_id"], True
            if r["letters"] is None:
                if r["kind"]:
                    text = r["text"]
                yield now, None, []
                continue
            out = []
            for letter in r["letters"]:
                if letter == "D":
                    out.append((letter, None, None))
                elif letter == "K":
                    state = _after(state, "sua".find(r["role"][:1]))
                    out.append((letter, r["role"], text))
                else:
                    state = _added(state)
                    out.append((letter, "assistant" if state == ASSISTANT else "user", text if letter == "R" else ""))
            yield now, r, out


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, seq (from 0), edit (K, R or I), role, text.

    Roles' initials then read `(s?(ua)+)?`; of the cheapest repairs the one whose audit letters
    (D, I, K, R) are least in ASCII.  A role is judged by its first letter, s, u or a, and other
    roles, the empty one included, cannot be kept.  Conversations without rows give none.
    See `decisions` for nulls, ties and repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        last, seq, begun = None, 0, False
        for conv, _, made in _walk(batches):
            if not begun or conv != last:
                last, seq, begun = conv, 0, True
            for letter, role, text in made:
                if letter != "D":
                    out.append({"conv_id": conv, "seq": seq, "edit": letter, "role": role, "text": text})
                    seq += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return _together(rows, decisions(rows), rows.select("conv_id").limit(0)).mapInArrow(run, "conv_id long, seq long, edit string, role string, text string")


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation of `ids`: faults, cost, audit and the digest of the repaired text.

    The digest and the audit are read off the stream of a conversation, in order: they are
    values of their own that no partial result can be put together to, but nothing
    except the audit is held for them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        now = None
        for conv, row, made in _walk(batches):
            if now is None or conv != now["conv_id"]:
                if now is not None:
                    out.append(_closed(now))
                now = {"conv_id": conv, "low": None, "high": None, "turns": 0, "faults": [0] * 4, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False}
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if row is None:
                continue
            if row["turn"] is not None:
                now["low"] = row["turn"] if now["low"] is None else min(now["low"], row["turn"])
                now["high"] = row["turn"] if now["high"] is None else max(now["high"], row["turn"])
            now["turns"] += row["new_turn"]
            now["faults"][row["fault"]] += 1
            now["illegal"] += row["illegal"]
            now["audit"].append(row["letters"])
            for letter, role, text in made:
                now["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[letter] + (TRUNCATED if letter in "KR" and row["fault"] == CUT_OFF else 0)
                if letter != "D":
                    now["sha"].update(("\n" if now["any"] else "").encode() + f"{role}:{text}".encode())
                    now["any"] = True
        if now is not None:
            out.append(_closed(now))
        yield pa.RecordBatch.from_pylist(out, schema)

    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in longs), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    stream = _together(rows, decisions(rows), ids.select("conv_id").distinct())
    return stream.mapInArrow(run, f"conv_id long, {', '.join(f'{c} long' for c in longs)}, audit string, repaired_sha256 string")


def _closed(now: dict) -> dict:
    gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
    faults = now["faults"]
    return {"conv_id": now["conv_id"], "gaps": gaps, "blank": faults[BLANK], "duplicate": faults[DUPLICATE], "truncated": faults[CUT_OFF], "illegal": now["illegal"], "cost": now["cost"], "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()}


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with the damage the query asks for; nulls in role and text read as one space."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.col("damage")
    rows = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), (F.crc32(key) % 20).alias("damage")).where("damage <> 0")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _check_sql() -> str:
    byte = "list_reduce(list_prepend(xor(c, b), [0::UBIGINT FOR i IN range(8)]), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, [ascii(ch)::UBIGINT FOR ch IN string_split(key, '')]), lambda c, b: {byte}), 4294967295::UBIGINT)"
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def best(*options: str) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL), 'ASC')[1]"

    def put(state: str, cost: str, letter: str, when: str = "true") -> str:
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"

    kept, given = "w.late", "3 + w.late"
    moved = {
        0: best(put("j0", "4", "D")),
        1: best(put("j1", "4", "D"), put("j0", kept, "K", "w.free AND w.i = 's'")),
        2: best(put("j2", "4", "D"), *(x for j in ("j0", "j1", "j3") for x in (put(j, kept, "K", "w.free AND w.i = 'u'"), put(j, given, "R", "w.free")))),
        3: best(put("j3", "4", "D"), put("j2", kept, "K", "w.free AND w.i = 'a'"), put("j2", given, "R", "w.free")),
    }
    inserted = f"s0 AS j0, s1 AS j1, {best('s2', *(put(s, '3', 'I') for s in ('s0', 's1', 's3')))} AS j2, {best('s3', put('s2', '3', 'I'))} AS j3"
    none = "NULL::STRUCT(c BIGINT, a VARCHAR)"
    return f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                          coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        h AS (SELECT *, ({crc}) % 20 AS damage FROM k),
        d AS (SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
                     CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE damage <> 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos, rtrim(text, {spaces}) AS body FROM d),
        f AS (SELECT *, substr(role, 1, 1) AS i, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS dup,
                     lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before, right(body, 1) NOT IN ('.', '!', '?') AS open FROM o),
        w AS (SELECT *, NOT blank AND NOT dup AS free, CASE WHEN open THEN 3 ELSE 0 END AS late FROM f),
        n AS (SELECT conv_id, max(pos) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
                     count(*) FILTER (free AND open) AS truncated, count(*) FILTER (pos > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY conv_id),
        dp AS (SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM n
               UNION ALL
               SELECT j.conv_id, w.pos, {moved[0]}, {moved[1]}, {moved[2]}, {moved[3]}
               FROM (SELECT conv_id, pos, {inserted} FROM dp) j JOIN w ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND w.pos = j.pos + 1),
        b AS (SELECT n.*, {best('s0', 's3', put('s2', '3', 'I'))} AS best FROM n JOIN dp ON dp.conv_id IS NOT DISTINCT FROM n.conv_id AND dp.pos = n.rows),
        l AS (SELECT conv_id, unnest(string_split(best.a, '')) AS letter, unnest(range(1, length(best.a) + 1)) AS place FROM b WHERE best.a <> ''),
        p AS (SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS pos, sum((letter <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS seq FROM l),
        q AS (SELECT p.*, w.role, w.text, w.i, bool_or(p.seq = 1 AND letter = 'K' AND w.i = 's') OVER (PARTITION BY p.conv_id) AS led
              FROM p LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.pos = p.pos WHERE letter <> 'D'),
        t AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (seq - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS repaired FROM q GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op11_weighted_repairs", _check_sql())
def op11(spark, sf):
    rows = table(spark, sf, "conversations")
    return report(damaged(rows), rows)
