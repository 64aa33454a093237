"""Geometry rewrites and pair predicates that run as Arrow-batched functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrain.functions import batches as B
from landgrain.functions import geometry as G
from landgrain.functions import kernels as K
from landgrain.functions import rings as R


def _rewriter(fn):
    """Column function: parts in, geometry out, row by row on flat buffers."""

    @F.arrow_udf(returnType=G.GEOMETRY_TYPE)
    def run(parts: pa.Array) -> pa.Array:
        rows = K.PartsReader(parts)
        return K.write_geometries([fn(rows.parts(i)) if rows.valid[i] else None for i in range(len(rows))])

    return run


def _splitter(fn, dim: int | None = None, batch=None, least: int = 1):
    """Column function: parts in, array of geometries out.

    `batch` does the same for all rows that are a single ring or line (`dim`) of at least `least`
    vertices, as flat rings; the others go to `fn` one by one.
    """

    @F.arrow_udf(returnType=T.ArrayType(G.GEOMETRY_TYPE))
    def run(parts: pa.Array) -> pa.Array:
        rows = K.PartsReader(parts)

        def each(picked):
            return K.write_geometry_lists([fn(p) if (p := rows.parts(i)) else [] for i in picked])

        if batch is None:
            return each(range(len(rows)))
        easy, xy, first = R.read(rows, dim, least)
        if not len(easy):
            return each(range(len(rows)))
        xy, first, owner = batch(xy, first)
        rest = np.setdiff1d(np.arange(len(rows)), easy, assume_unique=True)
        return R.merged(len(rows), easy, R.lists(owner, len(easy), R.write(xy, first, dim)), rest, each(rest))

    return run


def apply_parts(g, fn) -> Column:
    """An arbitrary function over [(dim, [ring])] of each geometry."""
    return _rewriter(fn)(G._col(g)["parts"])


def clean(g, tolerance: float = 1.0, precision: float = 1.0) -> Column:
    """Simplify, snap, drop repeats and collapsed rings."""

    @F.arrow_udf(returnType=G.GEOMETRY_TYPE)
    def run(parts: pa.Array) -> pa.Array:
        rows = K.PartsReader(parts)

        def each(picked):
            return K.write_geometries([K.clean(rows.parts(i), tolerance, precision, precision) if rows.valid[i] else None for i in picked])

        easy, *polygons = R.read_polygons(rows)
        if not len(easy):
            return each(range(len(rows)))
        rest = np.setdiff1d(np.arange(len(rows)), easy, assume_unique=True)
        return R.merged(len(rows), easy, R.write_polygons(*R.clean_polygons(*polygons, tolerance, precision, precision)), rest, each(rest))

    return run(G._col(g)["parts"])


def simplify(g, tolerance: float) -> Column:
    """G12."""
    return apply_parts(g, lambda p: K.simplify(p, tolerance))


def subdivide(g, max_vertices: int = 256, max_depth: int = 100, max_area: float | None = None) -> Column:
    """Array of pieces of at most max_vertices vertices (or max_area envelope area)."""

    def batch(xy, first):
        return R.halve_until(xy, first, max_vertices, max_depth, max_area)

    return _splitter(lambda p: K.halve_until(p, max_vertices, max_depth, max_area), 2, batch)(G._col(g)["parts"])


def pieces_of(g, max_vertices: int = 64) -> Column:
    """Array of pieces of at most max_vertices vertices; small geometries and boxes stay as they are."""
    g = G._col(g)
    big = ~g["boxy"] & (G.vertex_count(g) > max_vertices)
    return F.when(big, subdivide(F.when(big, g), max_vertices)).otherwise(F.array(g))


def fishnet(g, size: float) -> Column:
    """Array of pieces cut by a fixed square grid."""
    return _splitter(lambda p: K.fishnet(p, size), 2, lambda xy, first: R.fishnet(xy, first, size))(G._col(g)["parts"])


def segmentise(g, tolerance: float = 10.0, longest: float = 50.0) -> Column:
    """Array of sub-lines of each line part."""

    def cut(parts):
        return [[(1, [piece])] for dim, rings in parts if dim == 1 for ring in rings for piece in K.segmentise(ring, tolerance, longest)]

    return _splitter(cut, 1, lambda xy, first: R.segmentise(xy, first, tolerance, longest), 2)(G._col(g)["parts"])


def chords(g, spacing: float = 10.0) -> Column:
    """Array of equal chords of each line part."""

    def cut(parts):
        return [[(1, [piece])] for dim, rings in parts if dim == 1 for ring in rings for piece in K.chords(ring, spacing)]

    return _splitter(cut)(G._col(g)["parts"])


@F.arrow_udf(returnType=G.GEOMETRY_TYPE)
def _clip(parts: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    rows = K.PartsReader(parts)
    box = [c.to_numpy(zero_copy_only=False) for c in (x0, y0, x1, y1)]
    return K.write_geometries([K.clip_box(rows.parts(i), *(b[i] for b in box)) if rows.valid[i] else None for i in range(len(rows))])


def clip_to_box(g, x0, y0, x1, y1) -> Column:
    """The part of a geometry inside a box; boxes and points are clipped in closed form by callers."""
    return _clip(G._col(g)["parts"], *[G._dbl(c) for c in (x0, y0, x1, y1)])


def _distance_kernel(upto: float | None):
    @F.arrow_udf(returnType=T.DoubleType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right = B.read_edges(a), B.read_edges(b)
        rows = np.arange(len(left))
        out = B.pair_distances(left, rows, right, rows, upto)
        return pa.array(out, mask=np.isnan(out))

    return run


_distance = _distance_kernel(None)


def distance(a, b, upto: float | None = None) -> Column:
    """Exact distance; envelope arithmetic when both sides are boxes, otherwise the edge kernel.

    With `upto`, a larger distance may come out as infinity.
    """
    a, b = G._col(a), G._col(b)
    both = a["boxy"] & b["boxy"]
    kernel = _distance if upto is None else _distance_kernel(float(upto))
    hard = kernel(F.when(~both, a["parts"]), F.when(~both, b["parts"]))
    return F.when(both, G.envelope_distance(a, b)).otherwise(hard)


# -- map projection ------------------------------------------------------------

# Airy 1830 and WGS84 ellipsoids, the National Grid projection
# and the published seven-parameter shift between them.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
WGS_A, WGS_B = 6378137.0, 6356752.314245
SCALE, LAT0, LON0, FALSE_E, FALSE_N = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
SHIFT = (446.448, -125.157, 542.060, -20.4894, 0.1502, 0.2470, 0.8421)


def _meridian_arc(lat, lat0, a, b):
    n = (a - b) / (a + b)
    d, s = lat - lat0, lat + lat0
    return b * SCALE * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - (3 * n + 3 * n**2 + 21 / 8 * n**3) * np.sin(d) * np.cos(s)
        + (15 / 8) * (n**2 + n**3) * np.sin(2 * d) * np.cos(2 * s)
        - (35 / 24) * n**3 * np.sin(3 * d) * np.cos(3 * s)
    )


def grid_to_lonlat(east: np.ndarray, north: np.ndarray):
    """Inverse transverse Mercator, then a Helmert shift to WGS84 (about 5 m accuracy)."""
    a, b = AIRY_A, AIRY_B
    e2 = 1 - (b / a) ** 2
    lat0, lon0 = np.radians(LAT0), np.radians(LON0)
    lat = lat0 + (north - FALSE_N) / (a * SCALE)
    for _ in range(8):
        lat = lat + (north - FALSE_N - _meridian_arc(lat, lat0, a, b)) / (a * SCALE)
    sin2 = np.sin(lat) ** 2
    nu = a * SCALE / np.sqrt(1 - e2 * sin2)
    rho = a * SCALE * (1 - e2) / (1 - e2 * sin2) ** 1.5
    eta2 = nu / rho - 1
    t, sec = np.tan(lat), 1 / np.cos(lat)
    d = east - FALSE_E
    phi = (
        lat
        - t / (2 * rho * nu) * d**2
        + t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta2 - 9 * t**2 * eta2) * d**4
        - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * d**6
    )
    lam = (
        lon0
        + sec / nu * d
        - sec / (6 * nu**3) * (nu / rho + 2 * t**2) * d**3
        + sec / (120 * nu**5) * (5 + 28 * t**2 + 24 * t**4) * d**5
        - sec / (5040 * nu**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) * d**7
    )
    nu0 = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    x, y, z = nu0 * np.cos(phi) * np.cos(lam), nu0 * np.cos(phi) * np.sin(lam), (1 - e2) * nu0 * np.sin(phi)
    tx, ty, tz, ppm, rx, ry, rz = SHIFT
    s = 1 + ppm * 1e-6
    rx, ry, rz = (np.radians(v / 3600) for v in (rx, ry, rz))
    x, y, z = tx + x * s - y * rz + z * ry, ty + x * rz + y * s - z * rx, tz - x * ry + y * rx + z * s
    e2w = 1 - (WGS_B / WGS_A) ** 2
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2w))
    for _ in range(6):
        nu = WGS_A / np.sqrt(1 - e2w * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2w * nu * np.sin(lat), p)
    return np.degrees(np.arctan2(y, x)), np.degrees(lat)


@F.arrow_udf(returnType=G.VERTEX_TYPE)
def _lonlat(x: pa.Array, y: pa.Array) -> pa.Array:
    lon, lat = grid_to_lonlat(np.asarray(x.to_numpy(zero_copy_only=False), float), np.asarray(y.to_numpy(zero_copy_only=False), float))
    return pa.StructArray.from_arrays([pa.array(lon), pa.array(lat)], names=["x", "y"])


def lonlat(x, y) -> Column:
    """Longitude and latitude of a National Grid coordinate."""
    return _lonlat(G._dbl(x), G._dbl(y))


def to_lonlat(g) -> Column:
    """A whole geometry in longitude and latitude."""

    def project(parts):
        return [(dim, [np.column_stack(grid_to_lonlat(r[:, 0], r[:, 1])) for r in rings]) for dim, rings in parts]

    return apply_parts(g, project)
