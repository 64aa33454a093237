"""Well-known binary, well-known text and GeoJSON to and from geometry columns."""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrain.functions import geometry as G
from landgrain.functions.kernels import PartsReader, write_geometries

# OGC well-known binary codes, 2-D.
TYPE_CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}


def _read_wkb(buf: bytes, at: int = 0):
    order = "<" if buf[at] == 1 else ">"
    code = struct.unpack_from(order + "I", buf, at + 1)[0]
    at += 5
    if code & 0x20000000:
        at += 4
    width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    width += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    kind = code % 1000

    def coords(n, pos):
        xy = np.frombuffer(buf, dtype=order + "f8", count=n * width, offset=pos).reshape(n, width)[:, :2]
        return xy.astype(float), pos + 8 * n * width

    def count(pos):
        return struct.unpack_from(order + "I", buf, pos)[0], pos + 4

    if kind == 1:
        xy, at = coords(1, at)
        return ([] if np.isnan(xy).any() else [(0, [xy])]), at
    if kind == 2:
        n, at = count(at)
        xy, at = coords(n, at)
        return ([(1, [xy])] if n else []), at
    if kind == 3:
        n, at = count(at)
        rings = []
        for _ in range(n):
            m, at = count(at)
            xy, at = coords(m, at)
            rings.append(xy)
        return ([(2, rings)] if rings else []), at
    n, at = count(at)
    parts = []
    for _ in range(n):
        sub, at = _read_wkb(buf, at)
        parts += sub
    return parts, at


def _write_wkb(parts) -> bytes:
    def body(dim, rings):
        head = struct.pack("<BI", 1, dim + 1)
        if dim == 0:
            return head + np.asarray(rings[0], "<f8").tobytes()
        if dim == 1:
            return head + struct.pack("<I", len(rings[0])) + np.asarray(rings[0], "<f8").tobytes()
        return head + struct.pack("<I", len(rings)) + b"".join(struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes() for r in rings)

    if len(parts) == 1:
        return body(*parts[0])
    dims = {d for d, _ in parts}
    code = dims.pop() + 4 if len(dims) == 1 else 7
    return struct.pack("<BII", 1, code, len(parts)) + b"".join(body(d, r) for d, r in parts)


_COORDS = re.compile(r"\(([^()]*)\)")


def _floats(text: str) -> np.ndarray:
    return np.array([[float(v) for v in pair.split()[:2]] for pair in text.split(",") if pair.strip()]).reshape(-1, 2)


def _split_top(text: str) -> list:
    """Split a comma list at bracket depth 0."""
    out, depth, start = [], 0, 0
    for k, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(text[start:k])
            start = k + 1
    out.append(text[start:])
    return [t.strip() for t in out if t.strip()]


def _read_wkt(text: str):
    text = text.split(";", 1)[-1].strip()
    head, _, body = text.partition("(")
    kind = head.split()[0].upper()
    if not body:
        return []
    body = body.rsplit(")", 1)[0].strip()
    if kind == "POINT":
        return [(0, [_floats(body)])]
    if kind == "LINESTRING":
        return [(1, [_floats(body)])]
    if kind == "POLYGON":
        return [(2, [_floats(r) for r in _COORDS.findall(body)])]
    if kind == "MULTIPOINT":
        return [(0, [xy[None]]) for xy in _floats(body.replace("(", "").replace(")", ""))]
    if kind == "MULTILINESTRING":
        return [(1, [_floats(r)]) for r in _COORDS.findall(body)]
    if kind == "MULTIPOLYGON":
        return [(2, [_floats(r) for r in _COORDS.findall(p)]) for p in _split_top(body)]
    if kind == "GEOMETRYCOLLECTION":
        return [part for piece in _split_top(body) for part in _read_wkt(piece)]
    raise ValueError(f"unknown geometry type {kind}")


def _read_geojson(text: str):
    def build(node):
        kind = node["type"]
        if kind == "Feature":
            return build(node["geometry"])
        if kind == "GeometryCollection":
            return [part for g in node["geometries"] for part in build(g)]
        c = node["coordinates"]
        ring = lambda r: np.array(r, float).reshape(len(r), -1)[:, :2]
        if kind == "Point":
            return [(0, [ring([c])])]
        if kind == "MultiPoint":
            return [(0, [ring([p])]) for p in c]
        if kind == "LineString":
            return [(1, [ring(c)])]
        if kind == "MultiLineString":
            return [(1, [ring(r)]) for r in c]
        if kind == "Polygon":
            return [(2, [ring(r) for r in c])]
        return [(2, [ring(r) for r in p]) for p in c]

    return build(json.loads(text))


def _decoder(parse):
    @F.arrow_udf(returnType=G.GEOMETRY_TYPE)
    def decode(values: pa.Array) -> pa.Array:
        return write_geometries([None if v is None else parse(v) for v in values.to_pylist()])

    return decode


_wkb_geometry = _decoder(lambda v: _read_wkb(v)[0])
_wkt_geometry = _decoder(_read_wkt)
_geojson_geometry = _decoder(_read_geojson)


@F.arrow_udf(returnType=T.BinaryType())
def _parts_wkb(parts: pa.Array) -> pa.Array:
    rows = PartsReader(parts)
    return pa.array([_write_wkb(rows.parts(i)) if rows.valid[i] else None for i in range(len(rows))], pa.binary())


def from_wkb(column) -> Column:
    return _wkb_geometry(G._col(column))


def from_wkt(column) -> Column:
    return _wkt_geometry(G._col(column))


def from_geojson(column) -> Column:
    return _geojson_geometry(G._col(column))


def to_wkb(g) -> Column:
    return _parts_wkb(G._col(g)["parts"])


# -- text out, in Catalyst ---------------------------------------------------


def _number(v: Column) -> Column:
    whole = v == F.floor(v)
    return F.when(whole, v.cast("long").cast("string")).otherwise(v.cast("string"))


def _wkt_ring(r: Column) -> Column:
    pairs = F.transform(r, lambda v: F.concat(_number(v["x"]), F.lit(" "), _number(v["y"])))
    return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))


def _wkt_part(p: Column) -> Column:
    rings = F.transform(p["rings"], _wkt_ring)
    return F.when(p["dim"] == 2, F.concat(F.lit("("), F.array_join(rings, ", "), F.lit(")"))).otherwise(rings[0])


def to_wkt(g) -> Column:
    """Well-known text of a single-dimension geometry."""
    g = G._col(g)
    kind = F.upper(G.geometry_type(g))
    bodies = F.transform(g["parts"], _wkt_part)
    return (
        F.when(F.size(g["parts"]) == 0, F.lit("GEOMETRYCOLLECTION EMPTY"))
        .when(F.size(g["parts"]) == 1, F.concat(kind, F.lit(" "), bodies[0]))
        .otherwise(F.concat(kind, F.lit(" ("), F.array_join(bodies, ", "), F.lit(")")))
    )


def _json_ring(r: Column) -> Column:
    pairs = F.transform(r, lambda v: F.concat(F.lit("["), _number(v["x"]), F.lit(","), _number(v["y"]), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]"))


def _json_part(p: Column) -> Column:
    rings = F.transform(p["rings"], _json_ring)
    one = F.get(p["rings"], F.lit(0))[0]
    return (
        F.when(p["dim"] == 2, F.concat(F.lit("["), F.array_join(rings, ","), F.lit("]")))
        .when(p["dim"] == 1, rings[0])
        .otherwise(F.concat(F.lit("["), _number(one["x"]), F.lit(","), _number(one["y"]), F.lit("]")))
    )


def to_geojson(g) -> Column:
    """GeoJSON geometry text."""
    g = G._col(g)
    bodies = F.transform(g["parts"], _json_part)
    coordinates = F.when(F.size(g["parts"]) == 1, bodies[0]).otherwise(F.concat(F.lit("["), F.array_join(bodies, ","), F.lit("]")))
    return F.concat(F.lit('{"type":"'), G.geometry_type(g), F.lit('","coordinates":'), coordinates, F.lit("}"))
