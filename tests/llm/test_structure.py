"""Conversation repair, URL rules and periodic runs against plain versions, with their edge cases."""

import hashlib
import random
import re
import zlib

import pytest

import brute
from landgrain.llm import dialogues, periods, urls

ROWS = "conv_id long, turn long, role string, text string, digest string, part string"


# -- conversations -----------------------------------------------------------------------


def plain_repair(rows):
    """(audit, cost, repaired, faults) of (role, text) rows, by sorting (cost, audit) of all paths to a state."""
    seen, kinds = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\r\x0b\x0c")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def widen(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit, made) in list(out.items()):
                to = follows[state][-1]
                new = (cost + 3, audit + "I", (*made, ("user" if to == "u" else "assistant", "")))
                if to not in out or new[:2] < out[to][:2]:
                    out[to] = new
        return out

    for (role, text), kind in zip(rows, kinds):
        after = {}

        def offer(to, new):
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for state, (cost, audit, made) in widen(best).items():
            offer(state, (cost + 4, audit + "D", made))
            if kind in ("", "truncated"):
                more = cost + (3 if kind else 0)
                if role[:1] and role[:1] in follows[state]:
                    offer(role[0], (more, audit + "K", (*made, (role, text))))
                to = follows[state][-1]
                offer(to, (more + 3, audit + "R", (*made, ("user" if to == "u" else "assistant", text))))
        best = after
    cost, audit, made = min((v for k, v in widen(best).items() if k in ("", "a")), key=lambda v: v[:2])
    return audit, cost, "\n".join(f"{r}:{t}" for r, t in made), kinds


def plain_report(rows):
    """Reports of (conv_id, turn, role, text) rows by conversation, None among them."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        audit, cost, text, kinds = plain_repair([r[1:] for r in mine])
        turns = [r[0] for r in mine if r[0] is not None]
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def reported(frame):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in frame.collect()}


def random_rows(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "usher", "", None, "tool"]
    texts = ["Yes.", "No!", "open end", " \t", "", None, "ä?", "x. ", "long " * 50 + "."]
    return [(conv, rng.choice([None, k, k // 2, k * 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"row {k}" + rng.choice([".", "", "!\n"])) for k in range(n)]


def test_states_and_ranks_agree_with_whole_sums():
    rng = random.Random(3)
    for n in (1, 2, 9, 300, 700):
        classes = bytes(rng.choice([0, 4, 8, 4, 8, 5, 7, 11, 12, 2]) for _ in range(n))
        whole = dialogues.solve(classes, dialogues.START)
        ends = {e: (w + ((dialogues.END[e] >> 3) << 6 * n)) << 3 | dialogues.END[e] & 7 for e, w in whole.items() if dialogues.END[e] is not None}
        last = min(ends, key=ends.get)
        want = dialogues.letters(whole[last], n)
        if dialogues.END[last]:
            want[-1] += "I"
        assert dialogues.edits(classes) == want


def test_repair_equals_plain_version(spark):
    rng = random.Random(11)
    rows = [r for c in range(60) for r in random_rows(rng, c, rng.randint(1, 12))]
    rows += random_rows(rng, None, 8) + random_rows(rng, -5, 900)  # one conversation across blocks and partitions
    rows += [(70, 1, "system", "Only a rule."), (71, 1, "user", "a."), (71, 1, "user", "a."), (71, 1, "user", "a."), (72, None, None, None)]
    frame = spark.createDataFrame([(*r, "d", "p") for r in rows], ROWS).repartition(5)
    want = plain_report(rows)
    assert reported(dialogues.report(frame, frame)) == want
    texts = {}
    for r in sorted(dialogues.repair(frame).collect(), key=lambda r: r["seq"]):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(texts.get(c, [])).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(r[0], k, *r[2:]) for k, r in enumerate(random_rows(rng, 1, 1500))] + random_rows(rng, 2, 30)
    monkeypatch.setattr(dialogues, "ROWS", 150)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert reported(dialogues.report(frame, frame)) == plain_report(rows)


def test_conversations_without_rows(spark):
    none = spark.createDataFrame([], ROWS)
    ids = spark.createDataFrame([(None,), (4,), (4,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reported(dialogues.report(none, ids)) == {None: empty, 4: empty}
    assert dialogues.report(none, none).count() == dialogues.repair(none).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"Say {t}. Now!") for c in range(40) for t in range(6)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = dialogues.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# -- urls --------------------------------------------------------------------------------


def plain_glob(glob):
    out = "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x) or re.escape(x) for x in re.findall(r"\*\*|\*|\?|[^*?]+", glob))
    return re.compile(out, re.S)


def test_globs_equal_expressions():
    rng = random.Random(5)
    import pyarrow as pa

    from landgrain.llm.words import utf8

    for _ in range(60):
        globs = ["".join(rng.choice(["a", "b", "é", "*", "**", "?", "/", "."]) for _ in range(rng.randint(0, 30))).replace("***", "**") for _ in range(rng.randint(1, 12))]
        globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
        texts = ["".join(rng.choice("abé/.") for _ in range(rng.randint(0, 40))) for _ in range(40)] + [g.replace("*", "ab").replace("?", "é") for g in globs]
        hits = urls.Globs(globs).hits(*utf8(pa.array(texts)))
        want = [[plain_glob(g).fullmatch(t) is not None for g in globs] for t in texts]
        assert hits.tolist() == want


def test_verdicts(spark):
    rows = [
        (1, "https://WWW.Example.ORG/en/12?x=/es/"), (2, "http://example.org/es/#a"), (3, "http://example.org/ES/"), (4, "http://x.com/fr/a"), (5, "http://com/de/"),
        (6, "http://notexample.org"), (7, "http://a.net/b.org/"), (8, None), (9, "no scheme org/"), (9, "no scheme org/"), (None, "http://é.org/ü"), (10, "x://y://org/"),
        (11, "http://forg/"), (12, "http://a.org:80/"), (13, "http://org?x"), (14, "http://" + "a" * 200_000 + ".org/" + "b" * 200_000), (15, ""), (16, "x://A\nb.ORG/\n"),
    ]
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, verdict long")
    got = sorted((tuple(r) for r in urls.judge(frame).collect()), key=str)
    want = []
    for key, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in urls.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        top = max(fits, key=lambda r: len(r.name), default=None)
        want.append((key, host, path, top.name if top else None, top.verdict if top else "allow"))
    assert got == sorted(want, key=str)
    assert urls.judge(frame.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(frame, [], "block").collect()} == {"block"}


def test_equal_rules_and_many_words(spark):
    rules = [urls.Rule("block", f"h{k}.example.org", f"/p{k}") for k in range(200)] + [urls.Rule("allow", "b", "/x"), urls.Rule("block", "a.b", "/")]
    frame = spark.createDataFrame([(k, f"http://z.h{k}.example.org/p{k}/q") for k in range(200)] + [(300, "http://a.b/x"), (301, "http://h7.example.org/p8")], "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in urls.judge(frame, rules).collect()}
    assert got == {**{k: f"h{k}.example.org/p{k}" for k in range(200)}, 300: "a.b/", 301: None}


# -- periodic runs -----------------------------------------------------------------------


def plain_runs(words):
    """(start, length, period) of every run, by trying every period; equal stretches have the smallest."""
    out, n = {}, len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(6, 4 * p):
                out.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n_, p) for (s, n_), p in out.items())


def plain_run_report(words):
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def periodic_texts(rng):
    out = []
    for _ in range(220):
        words = []
        while len(words) < rng.choice([3, 20, 90, 400]):
            block = [rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.choice([1, 2, 3, 5, 8, 17, 40]))]
            words += block * rng.randint(1, 9) + block[: rng.randint(0, len(block))]
        out.append(words)
    fib = ["a", "a b"]
    while len(fib[-1]) < 4000:
        fib.append(fib[-1] + " " + fib[-2])
    return [*out, ["x"] * 5, ["x"] * 6, ["x"] * 3000, fib[-1].split(), (["p", "q"] * 4 + ["r"]) * 30]


@pytest.mark.parametrize("margin, span", [(24, 4096), (24, 8)])
def test_points_find_all_runs(margin, span, monkeypatch):
    import numpy as np

    monkeypatch.setattr(periods, "SPAN", span)
    for words in periodic_texts(random.Random(8)):
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64)
        hashes = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        spans = {}
        for octave, of, at in periods.grid_points(hashes, np.array([0, len(words)])):
            for points, lo, hi in periods.tiles_of(octave, at, len(words)):
                for g in points.tolist():
                    for p, a, b in periods.solve(octave, g, lo, len(words), codes[lo:hi].tolist()):
                        spans.setdefault(p, set()).add((a, b))
        got = []
        for p, found in spans.items():
            low = high = None
            for a, b in [*sorted(found), (1 << 60, 1 << 60)]:
                if high is None or a > high:
                    if high is not None and high - low + p >= max(6, 4 * p):
                        got.append((low, high - low + p, p))
                    low, high = a, b
                high = max(high, b)
        assert sorted(got) == plain_runs(words)


def test_runs_equal_plain_version(spark):
    texts = [" ".join(w) for w in periodic_texts(random.Random(9))]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, "a " * 9), (None, "b c"), (500, None), (501, ""), (502, " \n\x0b "), (503, "é\u00a0x é\u00a0x\té\u00a0x é\u00a0x é\u00a0x\r\né\u00a0x"), (504, "w " * 60_000 + "end " + " ".join(f"u{i % 7001}" for i in range(30_000)))]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, octave int").repartition(3)
    got = sorted(((r["doc_id"], *(r[c] for c in RUN_COLUMNS)) for r in periods.reports(frame).collect()), key=str)
    want = [(k, *plain_run_report(brute.WORD.findall(t or ""))) for k, t in rows if k != 504]
    assert [r for r in got if r[0] != 504] == sorted(want, key=str)
    long = next(r for r in got if r[0] == 504)
    assert long[1:6] == (2, 0, 60_000, 1, 60_000_000)
    runs = sorted(((r["doc_id"], r["start"], r["length"], r["period"]) for r in periods.periodic_runs(frame).collect()), key=str)
    assert [r for r in runs if r[0] != 504] == sorted(((k, *r) for k, t in rows if k != 504 for r in plain_runs(brute.WORD.findall(t or ""))), key=str)
    assert [r[1:] for r in runs if r[0] == 504] == [(0, 60_000, 1), (60_001, 30_000, 7001)]
    none = frame.limit(0)
    assert periods.reports(none).count() == periods.periodic_runs(none).count() == 0


def test_run_query_equals_plain_version(spark, sf_dir):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        words, h = brute.WORD.findall(r["text"] or ""), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want[r["doc_id"]] = plain_run_report(words) if len(words) < 3000 else None
    got = {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in periods.op13(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == w for k, w in want.items() if w)
