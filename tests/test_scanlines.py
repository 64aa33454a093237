"""Spans of raster cells against a test of every cell centre."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.operators import raster, scanlines


def inside(x, y, rings):
    """Even-odd rule; left and lower outlines belong to the shape."""
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if min(ay, by) <= y < max(ay, by):
                odd ^= ax + (y - ay) * (bx - ax) / (by - ay) <= x
    return odd


RINGS = {
    "concave": [[(0, 0), (40, 0), (40, 30), (20, 8), (0, 30), (0, 0)]],
    "hole": [[(-20, -20), (25, -15), (30, 30), (-18, 25), (-20, -20)], [(-5, -5), (10, -5), (10, 12), (-5, 12), (-5, -5)]],
    "sliver": [[(1, 1), (2, 1), (2, 2), (1, 1)]],
    "on_centres": [[(5, 5), (25, 5), (25, 25), (5, 25), (5, 5)]],
    "diamond": [[(5, 25), (25, 45), (45, 25), (25, 5), (5, 25)]],
}


def text(rings):
    return "(" + ",".join("(" + ",".join(f"{x} {y}" for x, y in r) + ")" for r in rings) + ")"


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(k, "POLYGON" + text(v)) for k, v in RINGS.items()]
    rows += [("two", "MULTIPOLYGON(" + text(RINGS["sliver"]) + "," + text([[(100, 100), (133, 104), (111, 140), (100, 100)]]) + ")"), ("line", "LINESTRING(0 0,50 50)"), ("dot", "POINT(5 5)")]
    return spark.createDataFrame(rows, "id string, wkt string").withColumn("geometry", C.from_wkt("wkt")).drop("wkt")


def expected(res, x0, y0):
    rings = {**RINGS, "two": [*RINGS["sliver"], [(100, 100), (133, 104), (111, 140), (100, 100)]]}
    span = range(-40, 80)
    return {(k, r, c) for k, v in rings.items() for r in span for c in span if inside((c + 0.5) * res + x0, (r + 0.5) * res + y0, v)}


@pytest.mark.parametrize("res,x0,y0", [(10.0, 0.0, 0.0), (3.0, 1.0, -2.0), (5.0, 2.5, 2.5)])
def test_cells_equal_a_test_of_every_centre(shapes, res, x0, y0):
    got = [tuple(r) for r in scanlines.cells(shapes, res, x0, y0).select("id", "row", "col").collect()]
    assert len(got) == len(set(got)) and set(got) == expected(res, x0, y0)


def test_cells_of_pixels(spark, shapes):
    pixels = spark.range(-40, 80).select(F.col("id").alias("row")).crossJoin(spark.range(-40, 80).select(F.col("id").alias("col")))
    pixels = pixels.withColumn("value", F.col("row") * 1000 + F.col("col")).withColumn("id", F.lit("pixel"))
    got = scanlines.cells_within(shapes, pixels, "id", 5.0, 2.5, 2.5)
    assert {(r.id, r.row, r.col) for r in got.collect()} == expected(5.0, 2.5, 2.5)
    sums = {r.id: r.s for r in raster.zonal(shapes, pixels.drop("id"), "id", [F.sum("value").alias("s")], 2.5, 2.5, 5.0).collect()}
    want = {}
    for k, r, c in expected(5.0, 2.5, 2.5):
        want[k] = want.get(k, 0) + r * 1000 + c
    assert sums == want


def test_large_polygon_is_spans(spark):
    """A diamond over 10^8 cells is one span per row, and neighbours share no cell."""
    big = spark.range(1).select(scanlines.spans(G.diamond(7071.0, 7071.0, 7071.0), 1.0).alias("s")).select(F.inline("s"))
    got = big.agg(F.count("*").alias("n"), F.sum(F.col("last") - F.col("first") + 1).alias("cells")).first()
    assert got.n == 2 * 7071 and abs(got.cells / (2 * 7071.0**2) - 1) < 1e-3
    halves = spark.createDataFrame([("a", "POLYGON((0 0,50 0,50 50,0 0))"), ("b", "POLYGON((0 0,50 50,0 50,0 0))")], "id string, wkt string")
    held = scanlines.cells(halves.select("id", C.from_wkt("wkt").alias("geometry")), 1.0)
    assert held.count() == held.select("row", "col").distinct().count() == 2500


def test_empty(spark, shapes):
    nothing = shapes.where("false").union(spark.createDataFrame([("none", None)], shapes.schema)).union(shapes.limit(1).select("id", G.empty().alias("geometry")))
    assert scanlines.cells(nothing, 5.0).count() == 0
