"""Large features in pieces, crowded cells in rounds, and unions kept as rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import geometry as G
from landgrain.functions import kernels as K
from landgrain.functions import shapes as S
from landgrain.functions.codecs import from_wkt
from landgrain.operators import linear, overlap
from landgrain.operators.spatial_join import Grid


def sea(spark, ring):
    rows = [("sea", "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring.tolist()) + "))")]
    return spark.createDataFrame(rows, "class string, wkt string").select("class", from_wkt("wkt").alias("geometry"))


def plain_spans(edge, ring):
    """Share of an edge inside a ring, cut at every crossing."""
    a, d = edge[:2], edge[2:] - edge[:2]
    cuts = [0.0, 1.0]
    for p, q in zip(ring[:-1], ring[1:]):
        r = q - p
        den = d[0] * r[1] - d[1] * r[0]
        if den:
            t, u = ((p - a)[0] * r[1] - (p - a)[1] * r[0]) / den, ((p - a)[0] * d[1] - (p - a)[1] * d[0]) / den
            if 0 <= u <= 1 and 0 < t < 1:
                cuts.append(t)
    cuts = np.unique(cuts)
    kept = K.inside(a + ((cuts[:-1] + cuts[1:]) / 2)[:, None] * d, [(2, [ring])])
    return float(((cuts[1:] - cuts[:-1]) * kept).sum())


def coast(n=3000, size=500.0):
    at = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = size * (0.7 + 0.2 * np.sin(5 * at) + 0.05 * np.sin(97 * at))
    ring = np.column_stack([500 + r * np.cos(at), 500 + r * np.sin(at)])
    return np.vstack([ring, ring[:1]])


def tiles(spark, n=100, side=10.0):
    return spark.range(n * n).select(F.concat(F.lit("p"), "id").alias("id_parcel"), G.rectangle(F.col("id") % n * side, F.floor(F.col("id") / n) * side, (F.col("id") % n + 1) * side, (F.floor(F.col("id") / n) + 1) * side).alias("geometry"))


def test_large_polygon_goes_out_in_small_pieces(spark):
    ring = coast()
    feature = sea(spark, ring)
    pieces = feature.select(F.explode(S.pieces_of("geometry", 64)).alias("g")).select(G.vertex_count("g").alias("n"), G.area("g").alias("a"), G._col("g")["boxy"].alias("boxy")).toPandas()
    assert pieces["n"].max() <= 64
    assert pieces["n"].sum() < 3 * len(ring)  # the outline and the cuts, not the outline per cell
    assert pieces["a"].sum() == pytest.approx(abs(K.signed_area(ring)), rel=1e-9)
    shares = overlap.parcel_proportion(tiles(spark), feature, ["class"], grid=Grid(10.0)).toPandas().set_index("id_parcel")["proportion"]
    assert shares.sum() * 100 == pytest.approx(abs(K.signed_area(ring)), rel=1e-9)
    assert (shares == 1).sum() > 3000
    for k in (5150, 1234, 2085, 8210):
        x, y = k % 100 * 10.0, k // 100 * 10.0
        want = K.slab_overlap([[[(2, [ring])]]], (x, y, x + 10, y + 10)) / 100
        assert shares.get(f"p{k}", 0.0) == pytest.approx(want, abs=1e-9)


def test_boundary_inside_a_large_polygon(spark):
    ring = coast()
    feature = sea(spark, ring)
    lines = spark.range(40).select(F.concat(F.lit("s"), "id").alias("id_boundary"), F.lit("p").alias("id_parcel"), G.segment(F.lit(0.0), F.col("id") * 25.0, F.lit(1000.0), F.col("id") * 25.0 + 3).alias("geometry"))
    spans = linear.buffer_spans(lines, feature, ["class"], [0.0], grid=Grid(50.0)).groupBy("id_boundary").agg(F.sum(F.expr("t1 - t0")).alias("t")).toPandas().set_index("id_boundary")["t"]
    for k in range(40):
        want = plain_spans(np.array([0.0, k * 25.0, 1000.0, k * 25.0 + 3]), ring)
        assert spans.get(f"s{k}", 0.0) == pytest.approx(want, abs=1e-9)


def diamonds(spark, n, kinds):
    return spark.range(n).select((F.col("id") % kinds).cast("string").alias("class"), G.diamond((F.col("id") * 37 % 101).cast("double"), (F.col("id") * 53 % 97).cast("double"), (4 + F.col("id") % 9).cast("double")).alias("geometry"))


def diamond_parts(k):
    x, y, r = k * 37 % 101, k * 53 % 97, 4 + k % 9
    return [(2, [np.array([[x - r, y], [x, y + r], [x + r, y], [x, y - r], [x - r, y]], float)])]


@pytest.mark.parametrize("crowd, fan", [(20_000, 32), (7, 32), (7, 2)])
def test_crowded_cells_in_rounds(spark, monkeypatch, crowd, fan):
    monkeypatch.setattr(overlap, "FAN", fan)
    parcels = spark.range(4).select(F.concat(F.lit("p"), "id").alias("id_parcel"), G.diamond(F.lit(50.0), F.col("id") * 20.0, F.lit(60.0)).alias("geometry"))
    got = {(r["id_parcel"], r["class"]): r["proportion"] for r in overlap.parcel_proportion(parcels, diamonds(spark, 300, 2), ["class"], grid=Grid(200.0, crowd, quarter=False)).collect()}
    for p in range(4):
        shape = [(2, [np.array([[-10, p * 20], [50, p * 20 + 60], [110, p * 20], [50, p * 20 - 60], [-10, p * 20]], float)])]
        for c in range(2):
            want = K.slab_overlap([[shape], [diamond_parts(k) for k in range(300) if k % 2 == c]], K.bounds(shape)) / 7200
            assert got[f"p{p}", str(c)] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("fan", [32, 3])
def test_union_of_a_class_as_rows(spark, monkeypatch, fan):
    monkeypatch.setattr(overlap, "FAN", fan)
    parcels = spark.range(2).select(F.concat(F.lit("p"), "id").alias("id_parcel"), G.rectangle(F.col("id") * 60.0, F.lit(0.0), F.col("id") * 60.0 + 40, F.lit(100.0)).alias("geometry"))
    extra = spark.range(2).select(F.lit("0").alias("class"), G.segment(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(100.0)).alias("geometry"))
    got = overlap.join_parcels(parcels, diamonds(spark, 120, 2).unionAll(extra), ["class"], grid=Grid(30.0)).select("id_parcel", "class", "piece", G.area("geometry_right").alias("a")).toPandas()
    assert got[got["piece"].isna()].groupby(["id_parcel", "class"]).size().to_dict() == {("p0", "0"): 1, ("p1", "0"): 1}
    areas = got.dropna().groupby(["id_parcel", "class"])["a"].sum().to_dict()
    for p in range(2):
        box = [(2, [np.array([[60 * p, 0], [60 * p, 100], [60 * p + 40, 100], [60 * p + 40, 0], [60 * p, 0]], float)])]
        for c in range(2):
            near = [diamond_parts(k) for k in range(120) if k % 2 == c and K.distance(box, diamond_parts(k)) == 0]
            assert areas[f"p{p}", str(c)] == pytest.approx(K.slab_overlap([near], (-50, -50, 200, 200)), rel=1e-9)
    assert overlap.join_parcels(parcels, diamonds(spark, 0, 2), ["class"]).count() == 0
