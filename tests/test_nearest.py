"""The k nearest rows against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import geometry as G
from landgrain.functions.codecs import _read_wkt
from landgrain.functions.kernels import distance
from landgrain.operators import nearest, raster
from test_spatial import frame, shapes


def ranked(left, right, k):
    out = {}
    for a, w in left:
        gaps = sorted((round(distance(_read_wkt(w), _read_wkt(v)), 9), b) for b, v in right)
        out[a] = [b for _, b in gaps[:k]]
    return out


def found(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r.a, r.rank)):
        out.setdefault(r.a, []).append(r.b)
    return out


@pytest.fixture()
def fine(monkeypatch):
    monkeypatch.setattr(nearest, "LEAF_ROWS", 8)
    monkeypatch.setattr(nearest, "CROWD", 6)
    monkeypatch.setattr(nearest, "REFINEMENTS", 2)


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_equals_brute_force(spark, fine, k):
    """Mixed shapes, a shape over the whole extent, copies on one spot and a row 1,000 km away."""
    rng = np.random.default_rng(3)
    left, right = shapes(rng, 40, "a"), shapes(rng, 80, "b")
    left += [("far", "POINT(1000000 40)"), ("wide", "POLYGON((-30 -30,130 -30,130 -28,-30 -28,-30 -30))")]
    right += [(f"c{i:02}", "POINT(50.5 50.5)") for i in range(40)] + [("ring", "LINESTRING(-50 -50,-50 150,150 150,150 -50)")]
    got = nearest.knn_nearest(frame(spark, left, "a"), frame(spark, right, "b"), "a", "b", k)
    assert found(got) == ranked(left, right, k)


def test_lone_rows_meet_few(spark):
    """Of 20,000 right rows on a lattice an isolated row meets those of a few leaves."""
    right = spark.range(20_000).select(F.col("id").alias("b"), G.point(F.col("id") % 200 * 10, F.floor(F.col("id") / 200) * 10).alias("geometry"))
    left = spark.createDataFrame([(1, -1e6, -1e6), (2, 995.0, 1e6)], "a long, x double, y double").select("a", G.point("x", "y").alias("geometry"))
    rows = [nearest._in_leaves(nearest._placed(df, c), -1e6, -1e6, 2.1e6 / 4**7, 7) for df, c in ((left, "a"), (right, "b"))]
    pairs = nearest._descend(*[nearest.durable(nearest._leaf_nodes(r)) for r in rows], 7, 1)
    met = pairs.join(rows[1].withColumnsRenamed({c: "r_" + c for c in nearest.NODE}), ["r_" + c for c in nearest.NODE]).groupBy("l__x").count().collect()
    assert len(met) == 2 and max(r["count"] for r in met) < 4000


def test_few_and_no_rows(spark, fine):
    left = frame(spark, [("a", "POINT(0 0)"), ("e", "POINT(9 9)")], "a")
    right = frame(spark, [("b", "POINT(3 4)")], "b")
    got = nearest.knn_nearest(left, right, "a", "b", 5).orderBy("a").collect()
    assert [(r.a, r.b, r["rank"]) for r in got] == [("a", "b", 1), ("e", "b", 1)] and got[0].distance == 5
    assert nearest.knn_nearest(left, right.where("false"), "a", "b", 2).count() == 0
    assert nearest.knn_nearest(left.where("false"), right, "a", "b", 2).count() == 0
    nothing = left.withColumn("geometry", G.empty())
    assert nearest.knn_nearest(nothing, right, "a", "b").count() == 0


def test_fill_over_half_a_raster(spark, fine):
    """One hole over half the raster, ties to the smaller (row, col)."""
    cells = [(c, r, None if c >= 8 or (c + r) % 5 == 0 else float(c * 100 + r)) for c in range(16) for r in range(16)]
    got = {(x.col, x.row): x.value for x in raster.fill_nearest(spark.createDataFrame(cells, "col long, row long, value double")).collect()}
    known = [(r, c, v) for c, r, v in cells if v is not None]
    want = {(c, r): v if v is not None else min(((c - kc) ** 2 + (r - kr) ** 2, kr, kc, kv) for kr, kc, kv in known)[3] for c, r, v in cells}
    assert got == want


def test_rows_of_a_leaf_meet_their_own_neighbours(spark, monkeypatch):
    """3,600 left rows beside a lattice: a left row meets the leaves near it, not all that its leaf needs, in tasks of few pairs."""
    right = spark.range(2_500).select(F.col("id").alias("b"), G.point(F.col("id") % 50 * 10, F.floor(F.col("id") / 50) * 10).alias("geometry"))
    left = spark.range(3_600).select(F.col("id").alias("a"), G.point(F.col("id") % 60 * 8 + 1, F.floor(F.col("id") / 60) * 8 + 1).alias("geometry"))
    rows, met = nearest._rows_in_nodes, []

    def seen(leaves, lf, nodes, k):
        out = rows(leaves, lf, nodes, k)
        every = leaves.join(lf.withColumnsRenamed({c: "l_" + c for c in nearest.NODE}), ["l_" + c for c in nearest.NODE])
        every = every.join(nodes.withColumnsRenamed({c: "r_" + c for c in nodes.columns}), ["r_" + c for c in nearest.NODE])
        met.append((every.agg(F.sum("r_n")).first()[0], out.agg(F.sum("r_n")).first()[0]))
        return out

    monkeypatch.setattr(nearest, "_rows_in_nodes", seen)
    monkeypatch.setattr(nearest, "MET_ROWS", 10_000)
    got = nearest.knn_nearest(left, right, "a", "b", 1).collect()
    want = {y * 60 + x: min((x * 8 + 1 - c * 10) ** 2 for c in range(50)) + min((y * 8 + 1 - c * 10) ** 2 for c in range(50)) for x in range(60) for y in range(60)}
    assert {r.a: round(r.distance**2) for r in got} == want
    (before, after), = met
    assert after < 0.6 * before and after < 100 * 3_600
