"""Text operators against plain versions, with nulls, empty tables, ties, repeats and clashing names."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from landgrain.llm import languages, licences, overlaps, packing, pairs, phrases, pieces, pseudonyms, signatures
from landgrain.llm.components import components

SCHEMA = "doc_id long, text string, score string"


def words(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


def documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


# -- packing -----------------------------------------------------------------------------


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted(rng.sample(range(40), rng.randint(1, 8)))
        counts = [rng.randint(1, 9) for _ in sizes]
        k = rng.randint(1, 4)

        def padding(ends):
            return sum(c * (next(e for e in ends if e >= s) - s) for s, c in zip(sizes, counts))

        got = packing.boundaries(sizes, counts, k)
        best = min(padding((*cut, sizes[-1])) for n in range(min(k, len(sizes))) for cut in itertools.combinations(sizes[:-1], n))
        assert len(got) <= k and got[-1] == sizes[-1] and padding(got) == best


def test_pack_edges(spark):
    rows = spark.createDataFrame([(1, 5), (1, 5), (1, 5), (None, 3), (2, None), (3, 9000), (4, 0)], "doc_id long, n_tokens long")
    got = packing.pack(rows, buckets=2, budget=10).collect()
    assert len(got) == 7
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == 7
    for r in got:
        assert r["n_tokens"] <= r["padded"] and r["slot"] < max(1, 10 // max(1, r["padded"]))
    assert packing.pack(rows.limit(0)).count() == 0


# -- licences ----------------------------------------------------------------------------


def test_licence_forms(spark):
    known = spark.createDataFrame([("B", "A licence, Version 2."), ("A", "a LICENSE version 2"), ("E", " ")], "license string, text string")
    docs = spark.createDataFrame([(1, "Copyright (c) 2020 me\r\nA  license -- v 2!"), (2, "x\nA licence version 2\ny"), (3, None), (3, ""), (None, "A license, version 2"), (2, "x\nA licence version 2\ny")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["text_license"], r["line_licenses"]) for r in licences.scan(docs, known).collect()), key=str)
    assert got == sorted([(0, "A", "A"), (1, "A", "A"), (2, None, "A"), (2, None, "A"), (3, None, None), (3, None, None)], key=str)
    assert licences.scan(docs.limit(0), known).count() == 0
    assert {r["text_license"] for r in licences.scan(docs, known.limit(0)).collect()} == {None}


def test_licence_spellings_are_whole_words(spark):
    same = ["License, v\n2 while v v licenses", "Licence, version 2\r\nWhilst version\nv LICENCES", "license version 2 whilst\nv\nversion licences"]
    other = ["favourite organisational", "favorite organizational", "v2", "version2", "whilsts", "whiles"]
    docs = spark.createDataFrame(list(enumerate(same + other)), "doc_id long, text string")
    got = {r["doc_id"]: r["canonical_sha256"] for r in licences.scan(docs, licences.notices(spark)).collect()}
    assert {got[k] for k in range(len(same))} == {hashlib.sha256(b"license version 2 while version version licenses").hexdigest()}
    assert [got[len(same) + k] for k in range(len(other))] == [hashlib.sha256(t.encode()).hexdigest() for t in other]


def test_licence_check_sql_has_the_same_rules(spark, sf_dir):
    """The check SQL on texts with every spelling inside words, beside marks and at line edges."""
    olds = [old for old, _ in licences.SPELLINGS]
    texts = [f"{a}\n{b} x{a} {a}y {b}{nl}{a}, ({b})" for a in olds for b in ("v", "Whilst") for nl in ("\r", "\r\n", "\n\n")]
    texts += [None, "", " \n ", "(c) 2020\nReleased under the MIT Licence.\nCopyright me", "Released under\nthe MIT License.", "Licensed under the Apache Licence, v 2.0", "released under the MIT licence\nx\nLicensed under CC BY 4.0."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = licences.scan(docs, licences.notices(spark)).select("doc_id", "canonical_sha256", "text_license", "line_licenses")
    want = con.execute(f"SELECT doc_id, canonical_sha256, text_license, line_licenses FROM ({licences._check_sql()})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {w[2] for w in want} >= {"MIT", None}


# -- near copies -------------------------------------------------------------------------


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(100, 130)] + [(7, k) for k in range(200, 240)] + [(5, 5), (None, 3), (1, 2), (2, 1)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{k: 100 for k in range(101, 131)}, **{k: 7 for k in range(200, 240)}, 2: 1}


def test_near_fingerprints_are_linked(spark):
    rng = random.Random(5)
    prints = {}
    for k in range(40):
        f = rng.getrandbits(64)
        for j in range(rng.randint(1, 12)):
            prints[k * 20 + j] = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
    # one crowded block: 600 fingerprints that agree in half of their bits
    for j in range(600):
        prints[5000 + j] = (0x9E3779B9 << 32) | (j * 0x01010101 & 0xFFFFFFFF)
    want = brute.components(prints)
    first = {}
    for i, f in sorted(prints.items()):
        first.setdefault(f, i)
    rows = [(f - (1 << 64) if f >> 63 else f, i) for f, i in first.items()]
    roots = {r["node"]: r["root"] for r in components(pairs.links(spark.createDataFrame(rows, "fp long, node long"))).collect()}
    for i, f in prints.items():
        assert roots.get(first[f], first[f]) == want[i][1]


def test_simhash_of_whole_tables(spark, sf_dir):
    docs, texts = documents(spark, sf_dir)
    want = brute.components({i: brute.fingerprint(t) for i, t in texts.items()})
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in pairs.near_duplicates(docs).collect()}
    assert got == want


def test_simhash_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (None, "only here at all", "d"), (9, "Ab", "e"), (8, "ab", "f"), (8, "ab", "f")], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["component_id"], r["fingerprint"] == "0" * 16) for r in pairs.near_duplicates(docs).collect() if r["doc_id"])
    assert got == [(1, 1, True), (2, 1, True), (3, 1, True), (8, 8, False), (8, 8, False), (9, 8, False)]
    assert sorted(r["doc_id"] or 0 for r in pairs.one_of_each(docs).collect()) == [0, 1, 8, 8]
    assert pairs.near_duplicates(docs.limit(0)).count() == 0


def test_overlaps_equal_counting(spark, sf_dir, monkeypatch):
    rng = random.Random(11)
    common = words(0, 60).split()
    texts, k = {}, 0
    for size in (5, 6, 9, 20, 40, 90, 300):
        for _ in range(4):
            base = [f"x{rng.randrange(10**6)}" for _ in range(size)] + common * (size == 40)
            for share in (0, 0.005, 0.01, 0.02, 0.03, 0.05):
                texts[k] = " ".join(f"y{rng.randrange(10**6)}" if rng.random() < share else w for w in base).upper()
                k += 7
    texts |= {1: None, 2: "", 3: " \n", 8: "One Two", 9: "one two"}
    docs = spark.createDataFrame([*texts.items(), (None, "one two")], "doc_id long, text string")
    want = brute.near_by_counting(texts)
    for slices in (pairs.SLICE, 3):
        monkeypatch.setattr(overlaps, "SLICE", slices)
        assert {r["doc_id"]: r["component_id"] for r in overlaps.near_sets(docs).collect()} == want
    assert overlaps.near_sets(docs.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in overlaps.one_of_each(docs).collect() if r["doc_id"] is not None) == sorted({*want.values()})


def test_shared_blocks(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(60), rng.randrange(-5, 5)) for _ in range(150)] + [(7, 100 + k % 50) for k in range(300)]
    members = {}
    for block, node in rows:
        members.setdefault(block, set()).add(node)
    want = sorted((b, min(m), x) for b, m in members.items() if len(m) > 1 for x in m)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("1", "3", size):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            assert sorted(map(tuple, overlaps._shared(spark.createDataFrame(rows, "block long, node long")).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_pipeline_drops_edited_copies(spark, sf_dir):
    import corpus_pipeline

    docs, texts = documents(spark, sf_dir)
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()}
    assert got == set(brute.near_by_counting(texts).values())


# -- repeats -----------------------------------------------------------------------------


def test_repeats_of_whole_tables(spark, sf_dir):
    docs, texts = documents(spark, sf_dir)
    want = brute.removals(texts.items())
    for r in phrases.remove_repeats(docs).collect():
        kept, n = want[r["doc_id"]]
        assert (r["kept"], r["n_removed"], r["n_words"]) == (" ".join(kept), n, n + len(kept))


def test_repeat_edges(spark):
    rows = [(1, words(0, 30)), (1, words(100, 130)), (1, words(0, 30)), (2, words(5, 25) + " q " + words(100, 113)), (2, "b " * 40), (3, "b " * 50 + words(100, 112)), (None, words(0, 30)), (4, None), (5, ""), (5, "b " * 14), (6, words(0, 12)), (7, words(3, 40))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in phrases.remove_repeats(docs).collect())
    assert got == [(0, 30, 0), (1, 30, 0), (1, 30, 0), (1, 30, 0), (2, 34, 33), (2, 40, 0), (3, 62, 50), (4, 0, 0), (5, 0, 0), (5, 14, 14), (6, 12, 0), (7, 37, 27)]
    assert phrases.remove_repeats(docs.limit(0)).count() == 0
    kept = phrases.without_repeats(spark.createDataFrame([(1, "a\nb", 3)], "doc_id long, text string, n_chars long")).first()
    assert (kept["text"], kept["n_chars"]) == ("a\nb", 3)


# -- fingerprints ------------------------------------------------------------------------


def test_neighbours(spark, sf_dir):
    docs, texts = documents(spark, sf_dir)
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in signatures.neighbours(docs, range_bytes=50_000).collect()}
    for i, j in zip(order, order[1:] + order[:1]):
        a, b = texts[i], texts[j]
        k = len(a) // 3
        edited = (a[: len(a) - k] + b[:k]).encode()
        mine, new, after = signatures.signatures([a.encode(), edited, b.encode()])
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"], got[i]["n_chars"]) == (mine, new, len(a))
        assert got[i]["edited_sha256"] == hashlib.sha256(edited).hexdigest()
        assert got[i]["near_edited"] == signatures.likeness(mine, new) and got[i]["near_next"] == signatures.likeness(mine, after)


def test_neighbour_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, "abc" * 50), (2, "abc" * 50), (None, "z" * 9)], "doc_id long, text string")
    got = signatures.neighbours(docs).collect()
    assert len(got) == 4 and all(0 <= r["near_next"] <= 1 for r in got)
    one = signatures.neighbours(docs.where("text like 'z%'")).first()
    assert (one["near_next"], one["edited_sha256"]) == (1.0, hashlib.sha256(b"z" * 9).hexdigest())
    assert signatures.neighbours(docs.limit(0)).count() == 0


def test_common_length():
    rng = random.Random(2)
    for _ in range(100):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert signatures.common_length(a, b) == t[-1, -1]


# -- pseudonyms --------------------------------------------------------------------------


def test_permutations_are_bijections():
    for radices in ([10, 10, 10], [26, 10], [7], [3, 5, 4]):
        every = list(itertools.product(*map(range, radices)))
        assert {tuple(pseudonyms.permute(list(x), radices, b"k", "t")) for x in every} == set(every)


@pytest.mark.parametrize("value", ["4111 1111 1111 1111", "123-45-6789", "2024-02-29", "31/12/1999", "12/31/1999", "DE89 3704 0044 0532 0130 00", "+1 (279) 555-0216", "192.168.0.1", "a.b+c9@x.example.com", "4610568901970798", "+44 20 7946 0958"])
def test_pseudonyms_keep_the_format(value):
    new, n = pseudonyms.pseudonymise(f"x {value}.")
    body = new[2:-1]
    assert n == 1 and body != value
    if "@" not in value and value.count(".") != 3:
        assert [c if not c.isdigit() else "0" for c in body] == [c if not c.isdigit() else "0" for c in value]
    assert pseudonyms.pseudonymise(f"x {body}.")[1] == 1
    assert pseudonyms.pseudonymise(f"({value})")[0] == f"({body})"
    assert pseudonyms.pseudonymise(f"x {value}.", b"other")[0] != new


def test_plain_text_is_left_alone(spark):
    for text in ("version 2.0.", "999.1.1.1", "000-12-3456", "2023-02-30", "room 12 of 2024", "a@b", "12345", ""):
        assert pseudonyms.pseudonymise(text) == (text, 0)
    docs = spark.createDataFrame([(1, None, 5), (None, "call +1 (279) 555-0216", 6), (2, "", 7)], "doc_id long, text string, n_private int")
    got = sorted((r["doc_id"] or 0, r["text"] is None, r["n_private"]) for r in pseudonyms.replace_private(docs).collect())
    assert got == [(0, False, 1), (1, True, 0), (2, False, 0)]


@pytest.mark.parametrize("around", ["-{}", "_{}_", "...{}", "+{}", "* -{}, x", "%{}", "a -{}-", "({})", "+_-.{}"])
def test_marks_before_mail_addresses(around):
    plain = pseudonyms.pseudonymise("jane.b+c9@example.com")[0]
    assert "jane" not in plain
    assert pseudonyms.pseudonymise(around.format("jane.b+c9@example.com")) == (around.format(plain), 1)


@pytest.mark.parametrize("value", ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "378282246310005", "4610568901970798", "AT61 1904 3002 3457 3201", "AT611904300234573201", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "+44 20 7946 0958", "+442079460958", "+33 1 23 45 67 89", "+351 912 345 678"])
@pytest.mark.parametrize("after", [" 123", " 12/26", " 123 12/26", " 2026", " 50.00", " 1 2 3", " BIC", " BANK", " EUR 50", " BIC GIBAATWWXXX", "-123", "-2026"])
def test_values_before_more_groups(value, after):
    plain, n = pseudonyms.pseudonymise(value)
    assert n == 1 and plain != value
    if after[0] == "-" and value[:2].isalpha():
        return
    got = pseudonyms.pseudonymise(f"a {value}{after}")[0]
    assert got == f"a {plain}{after}"


def test_numbers_before_cards():
    plain = pseudonyms.pseudonymise("4111 1111 1111 1111")[0]
    assert plain != "4111 1111 1111 1111"
    for k in range(1, 100):
        got = pseudonyms.pseudonymise(f"{k} 4111 1111 1111 1111")[0]
        assert "1111 1111" not in got and not got.endswith(" 1111")


# -- languages ---------------------------------------------------------------------------


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = languages.train_and_identify(docs).where("held_out AND n_chars >= 200").selectExpr("avg(int(lang = lang_pred)) AS a", "min(score) AS low", "max(score) AS high").first()
    assert got["a"] >= 0.97 and 0 <= got["low"] <= got["high"] <= 1


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, "the the", "en", 1), (2, "der der", "de", 1), (3, None, "de", 1), (4, "12 !", None, 1), (5, "the", None, 1), (5, "the", None, 1)], "doc_id long, text string, lang string, score int")
    profiles = languages.learn(docs)
    got = sorted((r["doc_id"], r["lang_pred"]) for r in languages.identify(docs, profiles).collect())
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "en"), (5, "en")]
    assert languages.learn(docs.limit(0)) == {}
    assert {r["lang_pred"] for r in languages.identify(docs, {}).collect()} == {"und"}


# -- pieces ------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, sf_dir):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.public_model())
    vocabulary = pieces.Vocabulary.load(pieces.public_model())
    own = pieces.Codec(vocabulary)
    rng = random.Random(1)
    bits = [" ", "  ", "a", "aa", "the", "\n", "\t", "é", "﷽", "▁", "0", "12", ".", ",", "ing", "<0x0A>", "<s>", "<unk>", "\r", "ab", "ra", "日本", "🙂", "A", "==", "//", "n't", "\x00", "ll"]
    for text in ["", " ", "a" * 5000, "x y " * 500] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]:
        ids = own.encode(text)
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want and own.decode(ids) == sp.decode(want)
    docs, texts = documents(spark, sf_dir)
    for r in pieces.tokenize(docs.select("doc_id", "text"), vocabulary).collect():
        want = sp.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["ids"] == want and r["decoded"] == sp.decode(want) and r["n_tokens"] == len(want)
    got = pieces.tokenize(spark.createDataFrame([(1, None)], "n_tokens long, text string"), vocabulary).first()
    assert got["n_tokens"] == 2 and got["decoded"] == ""
