import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.operators import linear, overlap, tally
from landgrain.operators.spatial_join import Grid

TWO_SQUARE = "POLYGON((0 0,0 2,2 2,2 0,0 0))"
MULTI = "MULTIPOLYGON(((0 0,0 2,2 2,2 0,0 0)),((3 3,3 4,4 4,4 3,3 3)))"
UNIT = "POLYGON((0 0,0 1,1 1,1 0,0 0))"

CASES = [
    (TWO_SQUARE, ["LINESTRING(0 2,2 2)", UNIT], 0.25),
    (MULTI, ["LINESTRING(0 2,2 2)", UNIT], 0.2),
    (MULTI, ["LINESTRING(0 3,3 3)", UNIT], 0.2),
    (MULTI, ["LINESTRING(0 2,2 2)", "MULTIPOLYGON(((0 0,0 1,1 1,1 0,0 0)),((4 4,4 5,5 5,5 4,4 4)))"], 0.2),
    (
        MULTI,
        [
            UNIT,
            "POLYGON((1 1,1 2,2 2,2 1,1 1))",
            "LINESTRING(0 2,2 2)",
            "MULTIPOLYGON(((3 3,3 4,4 4,4 3,3 3)),((4 4,4 5,5 5,5 4,4 4)))",
        ],
        0.6,
    ),
]


def frame(spark, rows, names):
    return spark.createDataFrame(rows, names).withColumn("geometry", C.from_wkt("wkt")).drop("wkt")


@pytest.mark.parametrize("parcel,features,expected", CASES)
@pytest.mark.parametrize("grid", [Grid(1.0), Grid(100.0), Grid(0.7, crowd=1), Grid(100.0, crowd=2, quarter=False)])
def test_proportion(spark, parcel, features, expected, grid):
    parcels = frame(spark, [("AA00000001", parcel)], ["id_parcel", "wkt"])
    feats = frame(spark, [("a", f) for f in features], ["cls", "wkt"])
    rows = overlap.parcel_proportion(parcels, feats, ["cls"], grid=grid).collect()
    assert len(rows) == 1
    assert rows[0].proportion == pytest.approx(expected, abs=1e-9)


def test_touching_only_gives_zero(spark):
    parcels = frame(spark, [("p", TWO_SQUARE)], ["id_parcel", "wkt"])
    feats = frame(spark, [("a", "LINESTRING(0 2,2 2)"), ("b", "POLYGON((5 5,5 6,6 6,6 5,5 5))")], ["cls", "wkt"])
    rows = overlap.parcel_proportion(parcels, feats, ["cls"], grid=Grid(1.0)).collect()
    assert [(r.cls, r.proportion) for r in rows] == [("a", 0.0)]


SQUARE21 = [
    (0, "P", "LINESTRING(0 0,0 21)"),
    (1, "P", "LINESTRING(0 21,21 21)"),
    (2, "P", "LINESTRING(21 21,21 0)"),
    (3, "P", "LINESTRING(21 0,0 0)"),
]


@pytest.mark.parametrize("grid", [Grid(5.0), Grid(1000.0), Grid(50.0, crowd=1)])
def test_boundary_buffers(spark, grid):
    parcels = frame(spark, [("P", "POLYGON((0 0,0 21,21 21,21 0,0 0))")], ["id_parcel", "wkt"])
    segs = frame(spark, SQUARE21, ["id_boundary", "id_parcel", "wkt"]).withColumn("m", G.length("geometry"))
    feats = frame(spark, [("a", "LINESTRING(24 0,24 21)")], ["cls", "wkt"])
    out = linear.boundary_proportion(segs, feats, ["cls"], [0, 2, 4, 8, 12, 24], parcels, grid=grid)
    got = np.array([[r[f"proportion_{b}m"] for b in (0, 2, 4, 8, 12, 24)] for r in out.orderBy("id_boundary").collect()])
    side = [0, 0, 1 / 21, 5 / 21, 9 / 21, 1]
    assert np.allclose(got, [[0, 0, 0, 0, 0, 1], side, [0, 0, 1, 1, 1, 1], side], atol=1e-3)


def test_nearest_counts(spark):
    wkts = ["LINESTRING(0 0,0 20)", "LINESTRING(0 20,20 20)", "LINESTRING(20 20,20 0)", "LINESTRING(20 0,0 0)"]
    segs = frame(spark, [(i, "P", w) for i, w in enumerate(wkts)], ["id_boundary", "id_parcel", "wkt"]).withColumn("m", G.length("geometry"))
    pts = frame(spark, [(1, "POINT(21 10)"), (2, "POINT(25 10)"), (3, "POINT(16 3)"), (4, "POINT(100 100)")], ["fid", "wkt"])
    out = tally.nearest_segment_counts(segs, pts, "fid", [0, 2, 6, 10], drop_empty=True, grid=Grid(10.0))
    assert "count_0m" not in out.columns
    got = {r.id_boundary: [r.count_2m, r.count_6m, r.count_10m] for r in out.collect()}
    assert got[3] == [0, 1, 1]
    assert got[2] == [1, 2, 2]


def _random_shapes(rng, n, kind):
    out = []
    for i in range(n):
        c = rng.uniform(0, 60, 2)
        r = rng.uniform(2, 12)
        k = rng.integers(3, 7)
        ang = np.sort(rng.uniform(0, 2 * np.pi, k))
        pts = [(c[0] + r * np.cos(a), c[1] + r * np.sin(a)) for a in ang]
        ring = ",".join(f"{x} {y}" for x, y in [*pts, pts[0]])
        out.append((f"{kind}{i}", f"POLYGON(({ring}))"))
    return out


def _grid_area(parcel_wkt, feature_wkts, res=0.1):
    from landgrain.functions.codecs import _read_wkt
    from landgrain.functions.kernels import inside

    xs = np.arange(-15, 75, res) + res / 2
    pts = np.array([(x, y) for x in xs for y in xs])
    inp = inside(pts, _read_wkt(parcel_wkt))
    cover = np.zeros(len(pts), bool)
    for w in feature_wkts:
        cover |= inside(pts, _read_wkt(w))
    return (inp & cover).sum() * res * res


@pytest.mark.parametrize("grid", [Grid(7.0), Grid(200.0), Grid(40.0, crowd=3), Grid(200.0, crowd=5, quarter=False)])
def test_union_area_against_pixels(spark, grid):
    rng = np.random.default_rng(7)
    parcels, feats = _random_shapes(rng, 3, "p"), _random_shapes(rng, 25, "f")
    got = {
        r.id_parcel: r.area
        for r in overlap.shared_area(
            frame(spark, parcels, ["id_parcel", "wkt"]), [frame(spark, feats, ["fid", "wkt"]).drop("fid")], "id_parcel", [], grid
        ).collect()
    }
    for key, wkt in parcels:
        assert got.get(key, 0.0) == pytest.approx(_grid_area(wkt, [w for _, w in feats]), abs=1.5)


def test_round_buffers_against_pixels(spark):
    """Parcel share within 6 m of a bent line and a triangle, against distances on a fine grid."""
    from landgrain.functions.codecs import _read_wkt
    from landgrain.functions.kernels import _point_edges_distance, edges_of, inside

    parcel = "POLYGON((0 0,0 40,40 40,40 0,0 0))"
    shapes = ["LINESTRING(-5 10,20 15,25 50)", "POLYGON((30 5,38 5,34 12,30 5))"]
    parcels = frame(spark, [("p", parcel)], ["id_parcel", "wkt"])
    feats = frame(spark, [(w,) for w in shapes], ["wkt"])
    row = overlap.buffer_proportions(parcels, feats, [0, 6], grid=Grid(15.0)).first()
    xs = np.arange(0.05, 40, 0.1)
    pts = np.array([(x, y) for x in xs for y in xs])
    near, within = np.zeros(len(pts), bool), np.zeros(len(pts), bool)
    for w in shapes:
        parts = _read_wkt(w)
        within |= inside(pts, parts)
        for edge in edges_of(parts):
            near |= _point_edges_distance(pts, edge[None])[:, 0] <= 6
    assert row.proportion_all_0m == pytest.approx(within.mean(), abs=2e-3)
    assert row.proportion_all_6m == pytest.approx((near | within).mean(), abs=5e-3)


def test_random_metric_repeats(spark, sf_dir):
    from landgrain.plans import QUERIES

    a, b = (sorted(map(tuple, QUERIES["F21_random_metric"](spark, sf_dir).collect())) for _ in range(2))
    assert a == b and all(0 <= m < 1 for _, m in a)


def test_area_of_large_beside_small(spark):
    from landgrain.functions import geometry as G
    from landgrain.operators import overlap
    from landgrain.operators.spatial_join import Grid

    rows = [(k, float(x), float(y), float(s)) for k, x, y, s in [(0, 0, 0, 400), (1, 3, 3, 2), (2, 100, 100, 50), (3, 399, 399, 2)]]
    layer = [("c", 0.0, 0.0, 250.0), ("c", 200.0, 0.0, 100.0), ("c", 4.0, 4.0, 1.0), ("d", 101.0, 101.0, 3.0)]
    box = G.box_sql("x", "y", "x + s", "y + s")
    parcels = spark.createDataFrame(rows, "k int, x double, y double, s double").selectExpr("k", f"{box} AS geometry")
    feats = spark.createDataFrame(layer, "c string, x double, y double, s double").selectExpr("c", f"{box} AS geometry")
    want = {(0, "c"): 250 * 250 + 50 * 100, (1, "c"): 4, (2, "c"): 2500, (0, "d"): 9, (2, "d"): 9}
    for grid in (Grid(1.0), Grid(10.0), Grid(2.0, crowd=1), Grid(None)):
        got = {(r.k, r.c): r.area for r in overlap.shared_area(parcels, [feats], "k", ["c"], grid).collect()}
        assert got == pytest.approx(want)
