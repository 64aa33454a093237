"""Geometry values as nested columns, with measures in Catalyst expressions.

A geometry is a struct

    parts  array of (dim, rings); dim 0 point, 1 line, 2 polygon
           rings is an array of vertex arrays; a polygon's first ring is its
           shell, the others are holes; points and lines have one ring
    xmin, ymin, xmax, ymax   envelope
    boxy   the point set equals its envelope (rectangle, axis-parallel line,
           point), which lets predicates and distances be decided from the
           envelope alone

Coordinates are planar metres.  All functions take and return Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX = "struct<x:double,y:double>"
RING = f"array<{VERTEX}>"
PART = f"struct<dim:int,rings:array<{RING}>>"
PARTS = f"array<{PART}>"
GEOMETRY = f"struct<parts:{PARTS},xmin:double,ymin:double,xmax:double,ymax:double,boxy:boolean>"

VERTEX_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PART_TYPE = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("rings", T.ArrayType(T.ArrayType(VERTEX_TYPE)))])
PARTS_TYPE = T.ArrayType(PART_TYPE)
GEOMETRY_TYPE = T.StructType(
    [
        T.StructField("parts", PARTS_TYPE),
        *[T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")],
        T.StructField("boxy", T.BooleanType()),
    ]
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dbl(c) -> Column:
    if isinstance(c, (int, float)):
        return F.lit(float(c))
    return _col(c).cast("double")


def vertex(x, y) -> Column:
    return F.struct(_dbl(x).alias("x"), _dbl(y).alias("y"))


def part(dim: int, rings: Column) -> Column:
    return F.struct(F.lit(dim).alias("dim"), rings.alias("rings"))


def _geometry(parts, xmin, ymin, xmax, ymax, boxy) -> Column:
    return F.struct(
        parts.alias("parts"),
        xmin.alias("xmin"),
        ymin.alias("ymin"),
        xmax.alias("xmax"),
        ymax.alias("ymax"),
        boxy.alias("boxy"),
    )


# -- constructors ---------------------------------------------------------


def point(x, y) -> Column:
    x, y = _dbl(x), _dbl(y)
    return _geometry(F.array(part(0, F.array(F.array(vertex(x, y))))), x, y, x, y, F.lit(True))


def rectangle(x0, y0, x1, y1) -> Column:
    x0, y0, x1, y1 = _dbl(x0), _dbl(y0), _dbl(x1), _dbl(y1)
    ring = F.array(vertex(x0, y0), vertex(x0, y1), vertex(x1, y1), vertex(x1, y0), vertex(x0, y0))
    return _geometry(F.array(part(2, F.array(ring))), x0, y0, x1, y1, F.lit(True))


def segment(x0, y0, x1, y1) -> Column:
    """A two-point line."""
    x0, y0, x1, y1 = _dbl(x0), _dbl(y0), _dbl(x1), _dbl(y1)
    ring = F.array(vertex(x0, y0), vertex(x1, y1))
    return _geometry(
        F.array(part(1, F.array(ring))),
        F.least(x0, x1),
        F.least(y0, y1),
        F.greatest(x0, x1),
        F.greatest(y0, y1),
        (x0 == x1) | (y0 == y1),
    )


def box_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    """SQL text of `rectangle`, for building layers from expressions."""
    ring = ", ".join(_vertex_sql(x, y) for x, y in ((x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)))
    return _geometry_sql(2, ring, x0, y0, x1, y1, "true")


def segment_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    """SQL text of `segment`."""
    ring = f"{_vertex_sql(x0, y0)}, {_vertex_sql(x1, y1)}"
    low, high = f"least({x0}, {x1})", f"greatest({x0}, {x1})"
    return _geometry_sql(1, ring, low, f"least({y0}, {y1})", high, f"greatest({y0}, {y1})", f"({x0}) = ({x1}) OR ({y0}) = ({y1})")


def point_sql(x: str, y: str) -> str:
    """SQL text of `point`."""
    return _geometry_sql(0, _vertex_sql(x, y), x, y, x, y, "true")


def _vertex_sql(x: str, y: str) -> str:
    return f"named_struct('x', double({x}), 'y', double({y}))"


def _geometry_sql(dim: int, ring: str, xmin: str, ymin: str, xmax: str, ymax: str, boxy: str) -> str:
    return (
        f"named_struct('parts', array(named_struct('dim', {dim}, 'rings', array(array({ring})))), 'xmin', double({xmin}), "
        f"'ymin', double({ymin}), 'xmax', double({xmax}), 'ymax', double({ymax}), 'boxy', {boxy})"
    )


def line(ring: Column) -> Column:
    """A line through an array of vertices."""
    return from_parts(F.array(part(1, F.array(_col(ring)))))


def polygon(rings: Column) -> Column:
    """A polygon from an array of rings, shell first."""
    return from_parts(F.array(part(2, _col(rings))))


def diamond(cx, cy, radius) -> Column:
    """The square rotated by 45 degrees: |x-cx| + |y-cy| <= radius."""
    cx, cy, r = _dbl(cx), _dbl(cy), _dbl(radius)
    ring = F.array(vertex(cx - r, cy), vertex(cx, cy + r), vertex(cx + r, cy), vertex(cx, cy - r), vertex(cx - r, cy))
    return _geometry(F.array(part(2, F.array(ring))), cx - r, cy - r, cx + r, cy + r, F.lit(False))


def from_parts(parts: Column) -> Column:
    """Attach envelope and box flag to an array of parts."""
    parts = _col(parts)
    xs = F.transform(vertices_of(parts), lambda v: v["x"])
    ys = F.transform(vertices_of(parts), lambda v: v["y"])
    xmin, xmax, ymin, ymax = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    first = F.get(parts, F.lit(0))
    flat = (xmin == xmax) | (ymin == ymax)
    fills = (F.size(first["rings"]) == 1) & (_parts_area(parts) == (xmax - xmin) * (ymax - ymin))
    boxy = F.when(F.size(parts) != 1, F.lit(False)).when(first["dim"] == 0, F.lit(True)).when(first["dim"] == 1, flat).otherwise(~flat & fills)
    return F.when(parts.isNotNull(), _geometry(parts, xmin, ymin, xmax, ymax, F.coalesce(boxy, F.lit(False))))


def empty() -> Column:
    return F.struct(
        F.array().cast(PARTS).alias("parts"),
        *[F.lit(None).cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
        F.lit(False).alias("boxy"),
    )


def or_empty(g) -> Column:
    """A missing geometry becomes an empty one."""
    return F.coalesce(_col(g), empty())


# -- access ---------------------------------------------------------------


def vertices_of(parts: Column) -> Column:
    return F.flatten(F.flatten(F.transform(parts, lambda p: p["rings"])))


def vertices(g) -> Column:
    return vertices_of(_col(g)["parts"])


def vertex_count(g) -> Column:
    return F.aggregate(
        _col(g)["parts"],
        F.lit(0),
        lambda acc, p: acc + F.aggregate(p["rings"], F.lit(0), lambda n, r: n + F.size(r)),
    )


def dimension(g) -> Column:
    """Largest part dimension; null for an empty geometry."""
    return F.array_max(F.transform(_col(g)["parts"], lambda p: p["dim"]))


def geometry_type(g) -> Column:
    """OGC type name."""
    g = _col(g)
    parts = g["parts"]
    dims = F.array_distinct(F.transform(parts, lambda p: p["dim"]))
    base = F.element_at(F.array(F.lit("Point"), F.lit("LineString"), F.lit("Polygon")), F.get(dims, F.lit(0)) + 1)
    return (
        F.when(F.size(parts) == 0, F.lit("Empty"))
        .when(F.size(dims) > 1, F.lit("GeometryCollection"))
        .when(F.size(parts) > 1, F.concat(F.lit("Multi"), base))
        .otherwise(base)
    )


# -- measures -------------------------------------------------------------


def _ring_signed_area(ring: Column) -> Column:
    ox, oy = ring[0]["x"], ring[0]["y"]
    steps = F.when(F.size(ring) > 2, F.sequence(F.lit(1), F.size(ring) - 1)).otherwise(F.array().cast("array<int>"))
    twice = F.aggregate(
        steps,
        F.lit(0.0),
        lambda acc, i: acc
        + (ring[i - 1]["x"] - ox) * (ring[i]["y"] - oy)
        - (ring[i]["x"] - ox) * (ring[i - 1]["y"] - oy),
    )
    return twice / 2


def _ring_length(ring: Column) -> Column:
    steps = F.when(F.size(ring) > 1, F.sequence(F.lit(1), F.size(ring) - 1)).otherwise(F.array().cast("array<int>"))

    def step(acc, i):
        dx = ring[i]["x"] - ring[i - 1]["x"]
        dy = ring[i]["y"] - ring[i - 1]["y"]
        return acc + F.sqrt(dx * dx + dy * dy)

    return F.aggregate(steps, F.lit(0.0), step)


def _part_area(p: Column) -> Column:
    signed = F.transform(p["rings"], lambda r: F.abs(_ring_signed_area(r)))
    total = F.aggregate(signed, F.lit(0.0), lambda acc, a: acc + a)
    return F.when(p["dim"] == 2, 2 * F.coalesce(signed[0], F.lit(0.0)) - total).otherwise(F.lit(0.0))


def _parts_area(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + _part_area(p))


def area(g) -> Column:
    """G1: shells minus holes, summed over parts; 0 for points and lines."""
    g = _col(g)
    return F.when(g["boxy"], (g["xmax"] - g["xmin"]) * (g["ymax"] - g["ymin"])).otherwise(_parts_area(g["parts"]))


def length(g) -> Column:
    """Length of lines, perimeter of polygons."""
    return F.aggregate(
        _col(g)["parts"],
        F.lit(0.0),
        lambda acc, p: acc
        + F.when(
            p["dim"] >= 1,
            F.aggregate(p["rings"], F.lit(0.0), lambda a, r: a + _ring_length(r)),
        ).otherwise(F.lit(0.0)),
    )


def _moments(ring: Column, axis: str) -> Column:
    """First moment of a ring about its first vertex, signed."""
    ox, oy = ring[0]["x"], ring[0]["y"]
    origin = ox if axis == "x" else oy
    steps = F.when(F.size(ring) > 2, F.sequence(F.lit(1), F.size(ring) - 1)).otherwise(F.array().cast("array<int>"))

    def step(acc, i):
        a, b = ring[i - 1], ring[i]
        cross = (a["x"] - ox) * (b["y"] - oy) - (b["x"] - ox) * (a["y"] - oy)
        return acc + (a[axis] + b[axis] - 2 * origin) * cross

    return F.aggregate(steps, F.lit(0.0), step) / 6


def centroid(g) -> Column:
    """Area-weighted for polygons, length-weighted for lines, else the mean vertex."""
    g = _col(g)
    box = vertex((g["xmin"] + g["xmax"]) / 2, (g["ymin"] + g["ymax"]) / 2)

    def ring_term(r, is_shell, axis):
        signed = _ring_signed_area(r)
        weight = F.abs(signed)
        local = F.when(signed != 0, _moments(r, axis) / signed).otherwise(F.lit(0.0))
        value = (r[0][axis] + local) * weight
        return F.when(is_shell, value).otherwise(-value)

    def area_term(axis):
        return F.aggregate(
            F.filter(g["parts"], lambda p: p["dim"] == 2),
            F.lit(0.0),
            lambda acc, p: acc
            + F.aggregate(
                F.transform(p["rings"], lambda r, i: ring_term(r, i == 0, axis)),
                F.lit(0.0),
                lambda a, v: a + v,
            ),
        )

    def length_term(axis):
        def along(r):
            steps = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))

            def step(acc, i):
                dx = r[i]["x"] - r[i - 1]["x"]
                dy = r[i]["y"] - r[i - 1]["y"]
                return acc + (r[i][axis] + r[i - 1][axis]) / 2 * F.sqrt(dx * dx + dy * dy)

            return F.aggregate(steps, F.lit(0.0), step)

        return F.aggregate(
            g["parts"],
            F.lit(0.0),
            lambda acc, p: acc + F.aggregate(p["rings"], F.lit(0.0), lambda a, r: a + along(r)),
        )

    def vertex_mean(axis):
        vs = vertices(g)
        return F.aggregate(vs, F.lit(0.0), lambda acc, v: acc + v[axis]) / F.size(vs)

    total_area, total_length = _parts_area(g["parts"]), length(g)
    general = (
        F.when(total_area > 0, vertex(area_term("x") / total_area, area_term("y") / total_area))
        .when(total_length > 0, vertex(length_term("x") / total_length, length_term("y") / total_length))
        .otherwise(vertex(vertex_mean("x"), vertex_mean("y")))
    )
    return F.when(F.size(g["parts"]) == 0, F.lit(None)).when(g["boxy"], box).otherwise(general)


# -- rewrites -------------------------------------------------------------


def boundary(g) -> Column:
    """Polygon rings as line parts."""
    parts = F.flatten(
        F.transform(
            F.filter(_col(g)["parts"], lambda p: p["dim"] == 2),
            lambda p: F.transform(p["rings"], lambda r: F.struct(F.lit(1).alias("dim"), F.array(r).alias("rings"))),
        )
    )
    return from_parts(parts)


def extract(g, dim: int) -> Column:
    """Keep only the parts of one dimension."""
    return from_parts(F.filter(_col(g)["parts"], lambda p: p["dim"] == dim))


def translate(g, dx, dy) -> Column:
    g = _col(g)
    dx, dy = _dbl(dx), _dbl(dy)
    parts = _map_vertices(g["parts"], lambda v: F.struct((v["x"] + dx).alias("x"), (v["y"] + dy).alias("y")))
    return _geometry(parts, g["xmin"] + dx, g["ymin"] + dy, g["xmax"] + dx, g["ymax"] + dy, g["boxy"])


def _map_vertices(parts: Column, fn) -> Column:
    return F.transform(
        parts,
        lambda p: F.struct(
            p["dim"].alias("dim"),
            F.transform(p["rings"], lambda r: F.transform(r, fn)).alias("rings"),
        ),
    )


def snap(g, precision: float = 1.0) -> Column:
    """Round coordinates to a grid; rounding keeps order, so the envelope is the rounded envelope."""
    g, p = _col(g), F.lit(float(precision))

    def to_grid(v):
        return F.floor(v / p + 0.5) * p

    parts = _map_vertices(g["parts"], lambda v: F.struct(to_grid(v["x"]).alias("x"), to_grid(v["y"]).alias("y")))
    return _geometry(parts, *[to_grid(g[c]) for c in ("xmin", "ymin", "xmax", "ymax")], g["boxy"])


def flip(g) -> Column:
    """Swap the axes."""
    g = _col(g)
    parts = _map_vertices(g["parts"], lambda v: F.struct(v["y"].alias("x"), v["x"].alias("y")))
    return _geometry(parts, g["ymin"], g["xmin"], g["ymax"], g["xmax"], g["boxy"])


def is_empty(g) -> Column:
    return F.size(_col(g)["parts"]) == 0


def is_valid(g) -> Column:
    """Closed rings of at least four vertices enclosing an area; lines of two distinct vertices."""

    def ring_ok(r):
        closed = (r[0]["x"] == F.element_at(r, -1)["x"]) & (r[0]["y"] == F.element_at(r, -1)["y"])
        return (F.size(r) >= 4) & closed & (_ring_signed_area(r) != 0)

    def part_ok(p):
        return (
            F.when(p["dim"] == 2, (F.size(p["rings"]) > 0) & F.forall(p["rings"], ring_ok))
            .when(p["dim"] == 1, F.forall(p["rings"], lambda r: (F.size(r) >= 2) & (_ring_length(r) > 0)))
            .otherwise(F.forall(p["rings"], lambda r: F.size(r) >= 1))
        )

    return F.forall(_col(g)["parts"], part_ok)


def collect_multipart(g) -> Column:
    """O26 aggregate: all parts of a group as one multipart geometry."""
    return from_parts(F.flatten(F.collect_list(_col(g)["parts"])))


# -- closed forms on envelopes ---------------------------------------------


def envelope_overlap_area(a, b) -> Column:
    a, b = _col(a), _col(b)
    w = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    h = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def envelope_distance(a, b) -> Column:
    a, b = _col(a), _col(b)
    dx = F.greatest(a["xmin"] - b["xmax"], b["xmin"] - a["xmax"], F.lit(0.0))
    dy = F.greatest(a["ymin"] - b["ymax"], b["ymin"] - a["ymax"], F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def point_in_polygon(x, y, g) -> Column:
    """Even-odd test in Catalyst: is (x, y) inside a polygon geometry (edge rule: upward edges closed below)."""
    x, y, g = _dbl(x), _dbl(y), _col(g)

    def crossings(ring):
        def step(acc, i):
            a, b = ring[i - 1], ring[i]
            spans = (a["y"] <= y) != (b["y"] <= y)
            at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])
            return acc + F.when(spans & (at > x), F.lit(1)).otherwise(F.lit(0))

        return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0), step)

    total = F.aggregate(
        F.filter(g["parts"], lambda p: p["dim"] == 2),
        F.lit(0),
        lambda acc, p: acc + F.aggregate(p["rings"], F.lit(0), lambda a, r: a + crossings(r)),
    )
    return (total % 2) == 1


# -- grid cells -----------------------------------------------------------


def grid_tile(x, y, size: int) -> tuple[Column, Column]:
    """Lower-left corner of the square cell that holds a coordinate."""
    return (F.floor(_dbl(x) / size) * size).cast("long"), (F.floor(_dbl(y) / size) * size).cast("long")


def national_grid_name(x, y, digits: int = 1) -> Column:
    """British National Grid reference of a cell.

    digits 0, 1, 2 give 100 km, 10 km and 1 km tiles.  The 500 km square fixes
    the first letter and the 100 km square the second; the alphabet skips I.
    """
    x, y = _dbl(x), _dbl(y)
    e100, n100 = F.floor(x / 100000).cast("int"), F.floor(y / 100000).cast("int")
    # letters run west to east, then north to south, in 5 x 5 blocks; false origin is in square SV
    first = (F.lit(19) - n100) - (F.lit(19) - n100) % 5 + F.floor((e100 + 10) / 5).cast("int")
    second = ((F.lit(19) - n100) * 5) % 25 + e100 % 5
    letters = F.lit("ABCDEFGHJKLMNOPQRSTUVWXYZ")
    name = F.concat(F.substring(letters, first + 1, F.lit(1)), F.substring(letters, second + 1, F.lit(1)))
    if digits:
        unit = 10 ** (5 - digits)
        east = F.lpad((F.floor(x / unit) % 10**digits).cast("string"), digits, "0")
        north = F.lpad((F.floor(y / unit) % 10**digits).cast("string"), digits, "0")
        name = F.concat(name, east, north)
    return name


def hex_cell(x, y, size: float) -> tuple[Column, Column]:
    """Axial coordinates of the pointy-top hexagon of given side that holds a point."""
    x, y = _dbl(x), _dbl(y)
    q = (x * (3**0.5) / 3 - y / 3) / size
    r = (y * 2 / 3) / size
    s = -q - r
    rq, rr, rs = F.round(q), F.round(r), F.round(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fixed_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fixed_r = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return fixed_q.cast("long"), fixed_r.cast("long")
