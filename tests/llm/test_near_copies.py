"""Near copies go through SimHash links; texts are counted and solved in bounded portions."""

from landgrain.llm import languages, overlaps, pairs, periods

WORDS = [f"w{k}" for k in range(200)]


def test_near_copies_follow_fingerprint_links(spark, monkeypatch):
    near = " ".join([*WORDS[:-1], "end"])
    docs = spark.createDataFrame([(1, " ".join(WORDS)), (2, near), (3, "far " + " x".join(WORDS)), (4, " ".join(WORDS)), (5, "")], "doc_id long, text string")
    linked = []
    links = pairs.links
    monkeypatch.setattr(pairs, "links", lambda prints: linked.append(prints.count()) or links(prints))
    got = {r["doc_id"]: r["component_id"] for r in overlaps.near_sets(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5}
    assert linked and linked[0] >= 2


def test_portions_change_no_row(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "la casa " * (k + 2) if k % 2 else "the house of " * (k + 1), "es" if k % 2 else "en") for k in range(12)], "doc_id long, text string, lang string")
    before = sorted(map(tuple, languages.train_and_identify(docs).select("doc_id", "lang_pred", "score").collect()))
    runs = sorted(map(tuple, periods.reports(docs).collect()))
    monkeypatch.setattr(languages, "TEXT", 20)
    monkeypatch.setattr(periods, "TEXT", 20)
    monkeypatch.setattr(periods, "ROWS", 1)
    assert sorted(map(tuple, languages.train_and_identify(docs).select("doc_id", "lang_pred", "score").collect())) == before
    assert sorted(map(tuple, periods.reports(docs).collect())) == runs


def test_runs_name_few_pairs_of_components(spark, monkeypatch):
    """Nodes of one block that all are near each other are named by a forest first, and then no more."""
    base = [f"v{k}" for k in range(100)]
    texts = {k: " ".join(base[: 50 + k] + [f"own{k}"] + base[51 + k :]) for k in range(30)}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    infos = overlaps._per_set(docs.select(docs.doc_id.alias("key"), "text"), "key long, node long, fp long, size int, sketch binary", overlaps._summary)
    nodes = infos.selectExpr("node", "node AS `group`", "size", "sketch")
    spread = nodes.selectExpr("explode(array(1L, 2L)) AS block", "node")
    every = overlaps._candidates(spread, nodes).count()
    few = overlaps._candidates(spread, nodes, True)
    assert few.count() == 29 and every == 30 * 29 // 2
    assert overlaps.components(few).count() == 29


def test_long_sets_are_told_apart_inside_a_run(spark):
    """512 bits say nothing about sets of 1,500 shingles; the whole sketch does."""
    docs = spark.createDataFrame([(k, " ".join(f"{'s' if n < 10 else k}{n}" for n in range(1500))) for k in range(6)], "key long, text string")
    infos = overlaps._per_set(docs, "key long, node long, fp long, size int, sketch binary", overlaps._summary)
    nodes = infos.selectExpr("node", "node AS `group`", "size", "sketch")
    assert overlaps._candidates(nodes.selectExpr("1L AS block", "node"), nodes).count() == 0


def test_all_pairs_come_only_for_groups_whose_links_do_not_hold(spark, monkeypatch):
    """The second meeting of the sketches is left out if every pair named holds; else it gets the open groups alone."""
    base = [f"v{k}" for k in range(100)]
    texts = {k: " ".join(base[: 50 + k % 40] + [f"own{k}"] + base[51 + k % 40 :]) for k in range(30)}
    docs = spark.createDataFrame([*texts.items(), (90, "alone " * 9)], "doc_id long, text string")
    met, verified = [], []
    candidates, verify = overlaps._candidates, overlaps._verified
    monkeypatch.setattr(overlaps, "_candidates", lambda spread, nodes, forest=False: met.append(nodes.count()) or candidates(spread, nodes, forest))
    want = sorted(map(tuple, overlaps.near_sets(docs).collect()))
    assert [c for k, c in want if k < 30] == [0] * 30 and len(met) == 1

    # the pairs named first hold only between two groups of nodes; the others stay open and meet once more
    met.clear()
    monkeypatch.setattr(overlaps, "_verified", lambda pairs, docs, keys: verified.append(1) or (verify(pairs, docs, keys) if len(verified) > 3 else pairs.limit(0)))
    assert sorted(map(tuple, overlaps.near_sets(docs).collect())) == want
    assert len(met) == 2 and met[1] == 30


def test_further_links_join_known_components(spark):
    roots = spark.createDataFrame([(2, 1), (3, 1), (5, 4), (8, 7)], "node long, root long")
    links = spark.createDataFrame([(3, 5), (9, 8), (2, 3)], "u long, v long")
    assert sorted(map(tuple, overlaps._joined(roots, links).collect())) == [(2, 1), (3, 1), (4, 1), (5, 1), (8, 7), (9, 7)]
    assert overlaps._joined(roots, links.limit(0)) is roots


def test_texts_stay_where_they_are_if_few_documents_go(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "d"), (3, "a b c"), (2, "own"), (4, None), (5, "")], "doc_id long, text string")
    want = [(None, "a b c"), (1, "a b c"), (2, "a b c"), (2, "own"), (3, "a b c"), (3, "d"), (4, None)]
    plans = []
    for most in (overlaps.KEYS_SENT, 0):
        monkeypatch.setattr(overlaps, "KEYS_SENT", most)
        kept = overlaps.one_of_each(docs)
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
        plans.append(kept._jdf.queryExecution().optimizedPlan().toString())
    assert "broadcast" in plans[0] and "broadcast" not in plans[1]
