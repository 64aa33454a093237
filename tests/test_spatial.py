"""Spatial joins against brute force, under every cell layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.functions.codecs import _read_wkt
from landgrain.functions.kernels import distance
from landgrain.operators import raster, spatial_join as SJ
from landgrain.operators.spatial_join import Grid


def shapes(rng, n, kind):
    out = []
    for i in range(n):
        x, y = rng.uniform(0, 100, 2)
        pick = rng.integers(0, 3)
        if pick == 0:
            out.append((f"{kind}{i}", f"POINT({x} {y})"))
        elif pick == 1:
            dx, dy = rng.uniform(-15, 15, 2)
            out.append((f"{kind}{i}", f"LINESTRING({x} {y},{x + dx} {y + dy})"))
        else:
            a = np.sort(rng.uniform(0, 2 * np.pi, 5))
            r = rng.uniform(2, 12)
            ring = [(x + r * np.cos(t), y + r * np.sin(t)) for t in a]
            out.append((f"{kind}{i}", "POLYGON((" + ",".join(f"{p} {q}" for p, q in [*ring, ring[0]]) + "))"))
    return out


def frame(spark, rows, key):
    return spark.createDataFrame(rows, [key, "wkt"]).withColumn("geometry", C.from_wkt("wkt")).drop("wkt")


@pytest.fixture(scope="module")
def layers(spark):
    rng = np.random.default_rng(3)
    left, right = shapes(rng, 60, "a"), shapes(rng, 80, "b")
    # a third of the right side sits on one spot
    right += [(f"c{i}", "POINT(50.5 50.5)") for i in range(40)]
    gaps = {(a, b): distance(_read_wkt(w), _read_wkt(v)) for a, w in left for b, v in right}
    return frame(spark, left, "a"), frame(spark, right, "b"), gaps


GRIDS = [Grid(10.0), Grid(500.0), Grid(30.0, crowd=5), Grid(200.0, crowd=7, quarter=False), Grid(None)]


@pytest.mark.parametrize("grid", GRIDS)
@pytest.mark.parametrize("d", [0.0, 6.0])
def test_join_equals_brute_force(layers, grid, d):
    left, right, gaps = layers
    got = sorted((r.a, r.b) for r in SJ.sjoin(left, right, d, grid).select("a", "b").collect())
    assert got == sorted(k for k, v in gaps.items() if v <= d)


def test_variants_agree(layers):
    left, right, gaps = layers
    want = sorted(k for k, v in gaps.items() if v <= 3.0)
    for out in (
        SJ.sjoin_keys(left, right, "a", "b", 3.0, grid=Grid(20.0)),
        SJ.sjoin_envelopes(left, right, 3.0, 25.0, Grid(20.0)),
        SJ.sjoin_adaptive(left, right, 3.0, 64.0, 4),
        SJ.sjoin_small(left, right, 3.0),
        SJ.sjoin_small(left, right, 3.0, max_rows=10, grid=Grid(20.0)),
    ):
        assert sorted((r.a, r.b) for r in out.select("a", "b").collect()) == want


def test_text_forms_survive(spark):
    wkts = [
        "POINT (1 2)", "LINESTRING (0 0, 3 4)", "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))",
        "MULTIPOINT ((1 1), (2 2))", "MULTILINESTRING ((0 0, 1 1), (1 1, 2 2))", "MULTIPOLYGON (((0 0, 0 1, 1 1, 1 0, 0 0)), ((2 2, 2 3, 3 3, 3 2, 2 2)))",
    ]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkts)], "i int, wkt string").withColumn("g", C.from_wkt("wkt"))
    again = df.select("i", C.from_wkb(C.to_wkb("g")).alias("w"), C.from_geojson(C.to_geojson("g")).alias("j"))
    rows = again.select("i", G.geometry_type("w").alias("t"), G.area("w").alias("aw"), G.area("j").alias("aj"), G.length("j").alias("m")).orderBy("i").collect()
    assert [r.t for r in rows] == ["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon"]
    assert [r.aw for r in rows] == [0, 0, 15, 0, 0, 2] == [r.aj for r in rows]
    assert rows[1].m == 5


def test_lonlat(spark):
    # published worked example: TG 51409 13177 is 52 39 28.8 N, 1 42 57.8 E
    from landgrain.functions.shapes import lonlat

    r = spark.range(1).select(lonlat(F.lit(651409.903), F.lit(313177.270)).alias("p")).first().p
    assert abs(r.y - 52.658007) < 1e-4 and abs(r.x - 1.716073) < 1e-4


def test_composites_equal_a_fold(spark):
    rng = np.random.default_rng(5)
    rows = []
    for pixel in range(200):
        for rank in range(4):
            cloud = None if rng.random() < 0.3 else float(rng.integers(0, 5)) / 10
            rows.append((pixel, 0, f"s{rank}", rank, float(rng.random()), cloud))
    df = spark.createDataFrame(rows, "col long, row long, scene string, scene_rank int, ndvi double, cloud double")
    got = {r.col: (r.scene, r.ndvi) for r in raster.clearest_pixels(df, ["ndvi"]).collect()}
    for pixel in range(200):
        held = None
        for _, _, scene, _, ndvi, cloud in rows[pixel * 4 : pixel * 4 + 4]:
            if held is None or held[2] is None or (cloud is not None and held[2] > cloud):
                held = (scene, ndvi, cloud)
        want = held[1] if held[2] is None or held[2] <= 0.2 else None
        assert got[pixel] == (held[0], want)


def test_snow_free_equals_a_fold(spark):
    rng = np.random.default_rng(6)
    rows = []
    for pixel in range(200):
        for rank in range(4):
            ndvi = None if rng.random() < 0.3 else float(rng.random())
            ndsi = None if rng.random() < 0.2 else float(rng.integers(-2, 3)) * 0.32
            rows.append((pixel, 0, f"s{rank}", rank, ndvi, ndsi))
    df = spark.createDataFrame(rows, "col long, row long, scene string, scene_rank int, ndvi double, ndsi double")
    got = {r.col: r.scene for r in raster.snow_free_pixels(df, ["ndvi"]).collect()}
    for pixel in range(200):
        held = rows[pixel * 4]
        for after in rows[pixel * 4 + 1 : pixel * 4 + 4]:
            if held[4] is None or (held[5] is not None and held[5] < 0.32):
                held = after
        assert got[pixel] == held[2]


def test_snow_index_masks_no_data(spark):
    bands = spark.createDataFrame([(2000.0, 4000.0, 1000.0, 3000.0), (0.0, 4000.0, 0.0, 3000.0), (1000.0, 4000.0, 1000.0, 3000.0)], "red double, nir double, green double, swir double")
    got = [(r.ndvi, r.ndsi) for r in raster.ndvi_ndsi(bands, "red", "nir", "green", "swir").collect()]
    assert got == [(pytest.approx(1 / 3), 0.5), (None, None), (0.6, 0.5)]
    moved = [(r.ndvi, r.ndsi) for r in raster.ndvi_ndsi(bands, "red", "nir", "green", "swir", offset=-1000.0).collect()]
    assert moved == [(0.5, None), (None, None), (None, None)]


def test_null_keys_and_values_are_kept(spark):
    from landgrain.operators import ranking

    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), (None, 3, 7.0), (None, 4, 6.0), ("b", 5, None)], "g string, id long, v double")
    known = df.where("v IS NOT NULL")
    got = {r.id: r.position for r in ranking.row_numbers(known, "v", "id", ["g"]).collect()}
    assert got == {1: 1, 2: 2, 4: 1, 3: 2}
    assert {r.id: r["rank"] for r in ranking.average_rank(df, "v", "id").collect()} == {3: 1.0, 4: 2.0, 1: 3.5, 2: 3.5, 5: None}
    left = spark.createDataFrame([(None, 0), ("x", 100)], "k string, x long").selectExpr("k", f"{G.box_sql('x', 'x', 'x + 5', 'x + 5')} AS geometry")
    right = spark.createDataFrame([(1,)], "x long").selectExpr(f"{G.box_sql('x', 'x', 'x + 2', 'x + 2')} AS geometry")
    assert [r.k for r in SJ.sjoin_anti(left, right, ["k"], grid=SJ.Grid(20.0)).collect()] == ["x"]
    for rows in (0, 10):
        assert SJ.sjoin_small(left, right, max_rows=rows, grid=SJ.Grid(20.0), distance_col="gap").columns == ["k", "geometry_left", "geometry_right", "gap"]


def test_cycles_are_found(spark):
    from landgrain.sources import catalogue

    with pytest.raises(ValueError, match="cycle"):
        catalogue.lineage(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "name string, parent string"))


def test_large_beside_small(spark):
    rng = np.random.default_rng(8)

    def boxes(n, key, large):
        rows = [(f"{key}{i}", *rng.uniform(0, 1000, 2).tolist(), float(rng.choice([0.5, 3.0, 40.0]))) for i in range(n)]
        rows += [(f"{key}L{i}", 0.0, 0.0, side) for i, side in enumerate(large)]
        return spark.createDataFrame(rows, [key, "x", "y", "s"]).selectExpr(key, f"{G.box_sql('x', 'y', 'x + s', 'y + s')} AS geometry"), rows

    left, lrows = boxes(150, "a", [1000.0, 90.0])
    right, rrows = boxes(200, "b", [1000.0, 1000.0, 300.0])
    for d in (0.0, 7.0):
        want = sorted(
            (a, b)
            for a, x, y, s in lrows
            for b, u, v, t in rrows
            if max(u - x - s, x - u - t, 0.0) ** 2 + max(v - y - s, y - v - t, 0.0) ** 2 <= d * d
        )
        for grid in (Grid(1.0), Grid(5.0), Grid(None), Grid(2.0, crowd=10)):
            got = sorted((r.a, r.b) for r in SJ.sjoin(left, right, d, grid).select("a", "b").collect())
            assert got == want
    # a geometry touches few cells, however large
    cells = SJ.place(left, right, Grid(1.0), once=True)[0].groupBy("a", "_base").count()
    assert cells.agg(F.max("count")).first()[0] <= 36


def test_positions_follow_text_ties(spark):
    from landgrain.operators import ranking

    rows = [("k" if i % 3 else None, 1.0 if i % 2 else None, f"t{i * 37 % 101:03d}") for i in range(101)]
    df = spark.createDataFrame(rows, "g string, v double, name string")
    for descending in (False, True):
        got = {r.name: r.position for r in ranking.row_numbers(df, "v", "name", ["g"], descending=descending).collect()}
        for key in ("k", None):
            want = sorted((v is None, name) for g, v, name in rows if g == key)
            assert [got[name] for _, name in want] == list(range(1, len(want) + 1))
    assert ranking.row_numbers(df.limit(0), "v", "name").count() == 0
