"""Archives, vector search and the pipeline against plain versions."""

import random

import numpy as np
import pytest

import brute
from landgrain.llm import topk, warc


def test_loser_tree():
    rng = random.Random(4)
    for k in range(8):
        runs = [sorted(((rng.randint(0, 9),), (j, n)) for n in range(rng.randint(0, 6))) for j in range(k)]
        got = list(warc.LoserTree(runs))
        assert sorted(got) == sorted(v for r in runs for _, v in r)
        keys = {v: key for r in runs for key, v in r}
        assert [keys[v] for v in got] == sorted(keys[v] for v in got)


def test_captures(spark):
    long, tricky = "p" * 150, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 60
    rows = [(1, "http://b.a/x", long), (2, "https://www.a.b/", tricky), (3, None, long), (4, "http://b.a/x", "s"), (5, "http://b.a/x#f", "s"), (6, "u\r\nv", None), (2, "http://b.a/x", tricky), (None, "http://b.a/x", long), (7, "http://b.a/x", tricky)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.captures(pages).collect()
    assert len(got) == len(rows)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [(0, "revisit", 1), (1, "response", None), (2, "response", None), (2, "response", None), (3, "revisit", 1), (4, "response", None), (5, "response", None), (6, "response", None), (7, "revisit", 2)]
    assert {r["payload_bytes"] for r in got if r["page_id"] in (2, 7)} == {len(tricky.encode())}
    ordered = sorted(got, key=lambda r: (r["range_no"], r["seq"]))
    assert [(r["url_key"], r["ts"]) for r in ordered] == sorted((r["url_key"], r["ts"]) for r in got)
    assert [r["capture_no"] for r in ordered if r["url_key"] == "a,b)/x"] == [1, 2, 3, 4, 5, 6]
    assert warc.captures(pages.limit(0)).count() == 0


def test_top_products(spark):
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 3])]) for k in range(700)]
    rows += [(700 + k, [1.0] * 6) for k in range(40)] + [(800, None), (801, [1.0, None]), (802, [float("nan")] * 6), (803, [float("inf")] * 6), (804, []), (805, [2.0]), (None, [1.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = topk.quantise(vectors)
    got = {}
    for r in topk.top_products(q, q.where("vec_id % 50 = 0"), block=64, query_block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    kept = {k: np.pad(np.floor(np.array(v) * 256), (0, 6 - len(v))) for k, v in rows if k is not None and v is not None and None not in v and np.isfinite(v).all()}
    for k in [i for i in kept if i % 50 == 0]:
        want = sorted(((-int(kept[k] @ v), i) for i, v in kept.items() if i != k))[:5]
        assert got[k] == [(i, -s) for s, i in want]
    assert topk.top_products(q.limit(0), q).count() == 0 and topk.top_products(q, q.limit(0)).count() == 0
    two = q.where("vec_id IN (0, 1)")
    assert topk.top_products(two, two).count() == 2


def test_large_components_are_exact_or_refused(spark):
    rows = [(k, [float(2**40 + 256 * k), 1.0]) for k in range(3)] + [(3, [2.0**30, 2.0**30])]
    q = topk.quantise(spark.createDataFrame([(k, [x / 2**20 for x in v]) for k, v in rows], "vec_id long, embedding array<double>"))
    got = topk.top_products(q, q.where("vec_id = 0")).orderBy("rank").collect()
    whole = {k: [int(np.floor(x / 2**20 * 256)) for x in v] for k, v in rows}
    want = sorted((-sum(a * b for a, b in zip(whole[0], v)), k) for k, v in whole.items() if k)
    assert [(-r["score"], r["vec_id"]) for r in got] == want
    huge = topk.quantise(spark.createDataFrame([(0, [2.0**40, 2.0**40]), (50, [2.0**40, 2.0**40]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="fit 64 bits"):
        topk.top_products(huge, huge.where("vec_id % 50 = 0")).collect()
    with pytest.raises(Exception, match="beyond 64-bit"):
        topk.quantise(spark.createDataFrame([(0, [2.0**60])], "vec_id long, embedding array<double>")).collect()


def test_repeats_keep_a_column_named_like_the_group(spark):
    from landgrain.llm import phrases

    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, 7), (2, text + " end", 8)], "doc_id long, text string, __home long")
    got = {r["doc_id"]: (r["__home"], r["n_removed"]) for r in phrases.remove_repeats(docs).collect()}
    assert got == {1: (7, 0), 2: (8, 20)}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as P
    from landgrain.llm import pseudonyms

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    near = brute.near_by_counting(texts)
    texts = {i: t for i, t in texts.items() if near[i] == i}
    kept = brute.removals(texts.items())
    texts = {i: " ".join(kept[i][0]) if kept[i][1] else t for i, t in texts.items()}
    want = {i: len(brute.WORD.findall(pseudonyms.pseudonymise(t)[0])) for i, t in texts.items()}
    got = P.run(spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)
    now = docs
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns
