"""Areas shared by parcels and features.

Area adds up over grid cells.  The join lists parcels and features under their
cells; inside a cell the union of the features of one class is measured
against the part of the parcel in that cell; the cell results are summed.  The
rows of one cell are already together after the join, so the grouped step
needs no further shuffle, and a large parcel is spread over its cells.

Features with many vertices are cut into pieces of a few dozen vertices first: pieces
inside a feature are plain boxes, so a cell gets the vertices near it and no others.

A cell that stays crowded after quartering is measured slice by slice: each
slice reduces its features to the disjoint trapezoids of their union, and the
trapezoids of a bounded number of slices are united in every further round.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrain.functions import batches as B
from landgrain.functions import geometry as G
from landgrain.functions import kernels as K
from landgrain.functions import shapes as S
from landgrain.operators.spatial_join import CELL_KEY, KEY, Grid, choose_cell, durable, list_cells, only_boxes, plan_candidates, sjoin, survey

PIECE_NAMES = ("x0", "x1", "b0", "b1", "t0", "t1")
PIECE_ARROW = pa.struct([("tag", pa.int32()), *[(n, pa.float64()) for n in PIECE_NAMES]])
PIECE_TYPE = T.StructType([T.StructField("tag", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in PIECE_NAMES]])
CELL_RESULT = T.StructType(
    [T.StructField("area", T.DoubleType()), T.StructField("hit", T.BooleanType()), T.StructField("pieces", T.ArrayType(PIECE_TYPE))]
)


def _compact(g: Column, tag: Column) -> Column:
    """What the cell kernel needs of a feature: a box travels as its envelope only."""
    return F.struct(
        g["xmin"].alias("xmin"),
        g["ymin"].alias("ymin"),
        g["xmax"].alias("xmax"),
        g["ymax"].alias("ymax"),
        g["boxy"].alias("boxy"),
        F.exists(g["parts"], lambda p: p["dim"] == 2).alias("poly"),
        tag.alias("tag"),
        F.when(~g["boxy"], g["parts"]).alias("parts"),
    )


def _box_fields(s) -> np.ndarray:
    return np.column_stack([np.asarray(s.field(n)) for n in ("xmin", "ymin", "xmax", "ymax")])


def _cell_kernel(n_layers: int):
    @F.arrow_udf(returnType=CELL_RESULT)
    def measure(parcel: pa.Array, parcel_box: pa.Array, window: pa.Array, features: pa.Array, want_pieces: pa.Array) -> pa.Array:
        """Area of parcel x every layer's union inside the window, and whether anything meets the parcel."""
        n = len(features)
        pbox, win = _box_fields(parcel_box), _box_fields(window)
        flat = features.values
        fbox = _box_fields(flat)
        boxy, poly, tags = (np.asarray(flat.field(c)) for c in ("boxy", "poly", "tag"))
        wanted = np.asarray(want_pieces)
        plain = ~np.asarray(parcel.is_valid())
        parcels = B.read_edges(parcel, pbox, plain)
        shapes = B.read_edges(flat.field("parts"), fbox, boxy)
        offsets = np.asarray(features.offsets)
        counts = np.where(np.asarray(features.is_valid()), np.diff(offsets), 0)
        row, at = np.repeat(np.arange(n), counts), B.spread(offsets[:-1], counts)
        w = np.column_stack([np.maximum(pbox[:, :2], win[:, :2]), np.minimum(pbox[:, 2:], win[:, 2:])])
        areal = ((w[:, 2] > w[:, 0]) & (w[:, 3] > w[:, 1]))[row] & poly[at]

        def covered(some, layer, layers, pieces=False):
            """Common area of each row's parcel and the layers of the features `some`."""
            mine = np.unique(row[some])
            a, pn = B.spread(parcels.first[:-1][mine], parcels.counts()[mine]), parcels.counts()[mine]
            f, fn = B.spread(shapes.first[:-1][at[some]], shapes.counts()[at[some]]), shapes.counts()[at[some]]
            a_row, f_row = np.repeat(mine, pn), np.repeat(row[some], fn)
            a_area, f_area = parcels.dim[a] == 2, shapes.dim[f] == 2
            xy = np.concatenate([parcels.xy[a[a_area]], shapes.xy[f[f_area]]])
            group = np.concatenate([a_row[a_area], f_row[f_area]])
            level = np.concatenate([np.zeros(int(a_area.sum()), int), np.repeat(layer, fn)[f_area]])
            part = np.concatenate([2 * parcels.part[a[a_area]], 2 * shapes.part[f[f_area]] + 1])
            return B.common_areas(xy, group, level, part, layers, w, pieces)

        some = np.flatnonzero(areal & ~wanted[row])
        area = covered(some, tags[at[some]] + 1, n_layers + 1) if len(some) else np.zeros(n)
        pieces: list[list] = [[] for _ in range(n)]
        for t in range(n_layers):
            some = np.flatnonzero(areal & wanted[row] & (tags[at] == t))
            if len(some):
                for i, cut in enumerate(covered(some, np.ones(len(some), int), 2, pieces=True)[1]):
                    pieces[i] += [dict(zip(("tag", *PIECE_NAMES), (t, *r))) for r in cut]
        hit = (area > 0) | np.array([bool(r) for r in pieces], bool)
        hit[row[plain[row] & boxy[at]]] = True
        some = np.flatnonzero(~hit[row])
        touching = B.pair_distances(parcels, row[some], shapes, at[some], 0.0) == 0
        hit[row[some[touching]]] = True
        return pa.StructArray.from_arrays([pa.array(area), pa.array(hit), pa.array(pieces, pa.list_(PIECE_ARROW))], names=["area", "hit", "pieces"])

    return measure


def _piece_edges(pieces: pa.Array, n_layers: int):
    """Edges of arrays of trapezoids by row: (xy, row, tag, part, envelope of every row)."""
    offsets, flat = np.asarray(pieces.offsets), pieces.values
    counts = np.where(np.asarray(pieces.is_valid()), np.diff(offsets), 0)
    at, row = B.spread(offsets[:-1], counts), np.repeat(np.arange(len(pieces)), counts)
    tag = np.asarray(flat.field("tag"))[at]
    x0, x1, b0, b1, t0, t1 = (np.asarray(flat.field(c))[at] for c in PIECE_NAMES)
    windows = np.tile([np.inf, np.inf, -np.inf, -np.inf], (len(pieces), 1))
    for k, values, pick in ((0, x0, np.minimum), (1, np.minimum(b0, b1), np.minimum), (2, x1, np.maximum), (3, np.maximum(t0, t1), np.maximum)):
        pick.at(windows[:, k], row, values)
    xy = np.concatenate([np.column_stack([x0, b0, x1, b1]), np.column_stack([x0, t0, x1, t1])])
    return xy, np.tile(row, 2), np.tile(tag, 2), np.tile(np.arange(len(at)), 2), windows


def _piece_lists(rows: list[list], n_layers: int) -> pa.Array:
    """One array of trapezoids per row from lists by (row, layer)."""
    flat = [(k % n_layers, *r) for k, cut in enumerate(rows) for r in cut]
    ends = np.cumsum([0, *(sum(len(c) for c in rows[k : k + n_layers]) for k in range(0, len(rows), n_layers))])
    columns = list(zip(*flat)) if flat else [[] for _ in range(1 + len(PIECE_NAMES))]
    values = pa.StructArray.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.float64()) for c in columns[1:])], names=["tag", *PIECE_NAMES])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _merge_kernel(n_layers: int):
    @F.arrow_udf(returnType=T.ArrayType(PIECE_TYPE))
    def merge(pieces: pa.Array) -> pa.Array:
        """The trapezoids of the union of each layer's trapezoids."""
        xy, row, tag, part, windows = _piece_edges(pieces, n_layers)
        _, rows = B.common_areas(xy, row * n_layers + tag, np.zeros(len(row), int), part, 1, np.repeat(windows, n_layers, axis=0), pieces=True)
        return _piece_lists(rows, n_layers)

    return merge


def _union_kernel(n_layers: int):
    @F.arrow_udf(returnType=T.DoubleType())
    def unite(pieces: pa.Array) -> pa.Array:
        xy, row, tag, part, windows = _piece_edges(pieces, n_layers)
        return pa.array(B.common_areas(xy, row, tag, part, n_layers, windows))

    return unite


FAN = 32
"""Slices of trapezoids that are united in one row."""
PIECE_VERTICES = 64
"""Vertices of a piece of a feature."""


def merge_rounds(rows: DataFrame, keys: list[str], slices: int, n_layers: int, held: list[Column] = ()) -> DataFrame:
    """Unite the trapezoid arrays `pieces` of up to `slices` slices per key, `_slice` numbering them, FAN slices at a time.

    Returns (*keys, *held, pieces) with `held` as aggregates over the slices.  A row never holds more than
    the unions of FAN slices, and each round leaves a union in place of what overlapped.
    """
    merge = _merge_kernel(n_layers)
    while True:
        left = -(-slices // FAN)
        last = left <= 1
        group = keys if last else [*keys, F.floor(F.col("_slice") / FAN).alias("_slice")]
        rows = rows.groupBy(*group).agg(*held, F.flatten(F.collect_list("pieces")).alias("pieces"))
        if last:
            return rows
        rows, slices = rows.withColumn("pieces", merge("pieces")), left


def shared_area(
    parcels: DataFrame,
    layers: list[DataFrame],
    key: str | list[str] = "id_parcel",
    columns: list[str] = (),
    grid: Grid = Grid(),
) -> DataFrame:
    """Area of every parcel covered by all layers at once, each layer the union of its features per `columns`.

    Returns (key, *columns, parcel_area, area) for parcels met by some feature.
    """
    keys, columns = [key] if isinstance(key, str) else list(key), list(columns)
    raw = None
    for t, layer in enumerate(layers):
        one = layer.where(~G.is_empty("geometry")).select(*columns, F.lit(t).alias("_tag"), "geometry")
        raw = one if raw is None else raw.unionAll(one)
    left = parcels.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "geometry")
    held = [f"_k{i}" for i in range(len(keys))]
    if grid.cell is None:
        grid = replace(grid, cell=choose_cell(left, raw))
    seen = survey(left, raw, grid.cell)
    if seen.vertices[1] > PIECE_VERTICES:
        raw = durable(raw.dropDuplicates().withColumn("geometry", F.explode(S.pieces_of("geometry", PIECE_VERTICES))))
        seen = replace(seen, rows=(seen.rows[0], raw.count()))
    whole = raw.select(*columns, _compact(F.col("geometry"), F.col("_tag")).alias("geometry"))
    # a union does not change with copies: drop them before anything is replicated
    pairs, n_slices = plan_candidates(left, whole, grid, 0.0, once=False, copies=True, seen=seen)
    gl, gr = F.col("geometry_left"), F.col("geometry_right")
    window = F.struct(
        (F.col("_cx") * F.col("_side")).alias("xmin"),
        (F.col("_cy") * F.col("_side")).alias("ymin"),
        ((F.col("_cx") + 1) * F.col("_side")).alias("xmax"),
        ((F.col("_cy") + 1) * F.col("_side")).alias("ymax"),
    )
    groups = pairs.groupBy(*KEY, *held, *columns).agg(
        F.first(gl).alias("p"),
        F.first("_sr").alias("_sr"),
        F.first(window).alias("w"),
        F.collect_set(gr).alias("f"),
    )
    sliced = F.col("_sr") > 1
    p, w, f = F.col("p"), F.col("w"), F.col("f")
    one = f[0]
    if len(layers) == 1:
        simple = (F.size(f) == 1) & p["boxy"] & one["boxy"] & ~sliced
    else:
        simple = F.lit(False)

    def clipped(lo, hi):
        return F.greatest(F.least(p[hi], one[hi], w[hi]) - F.greatest(p[lo], one[lo], w[lo]), F.lit(0.0))

    closed = F.when(one["poly"], clipped("xmin", "xmax") * clipped("ymin", "ymax")).otherwise(F.lit(0.0))
    hard = _cell_kernel(len(layers))(
        F.when(~simple & ~p["boxy"], p["parts"]),
        F.struct(*[p[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]),
        w,
        F.when(~simple, f),
        sliced,
    )
    cells = groups.withColumn("r", hard).select(
        *held,
        *columns,
        *CELL_KEY,
        F.col("_i").alias("_slice"),
        G.area(p).alias("parcel_area"),
        F.when(simple, closed).otherwise(F.col("r.area")).alias("area"),
        (simple | F.col("r.hit")).alias("hit"),
        F.when(sliced, F.col("r.pieces")).alias("pieces"),
    )
    if n_slices:
        carried = [F.first("parcel_area").alias("parcel_area"), F.sum("area").alias("area"), F.max("hit").alias("hit")]
        united = merge_rounds(cells, [*held, *columns, *CELL_KEY], n_slices, len(layers), carried)
        cells = united.withColumn("area", F.col("area") + _union_kernel(len(layers))("pieces"))
    summed = (
        cells.groupBy(*held, *columns)
        .agg(F.first("parcel_area").alias("parcel_area"), F.sum("area").alias("area"), F.max("hit").alias("hit"))
        .where(F.col("hit"))
    )
    return summed.select(*[F.col(h).alias(k) for h, k in zip(held, keys)], *columns, "parcel_area", "area")


def clamp(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def parcel_proportion(
    parcels: DataFrame,
    features: DataFrame,
    columns: list[str] = (),
    key: str | list[str] = "id_parcel",
    snap: float | None = None,
    pre=None,
    post=None,
    grid: Grid = Grid(),
) -> DataFrame:
    """O2: share of each parcel covered by the union of the features of each class.

    pre and post are table-to-table hooks (U8).  snap cleans the features to a
    coordinate grid first; None measures them as they are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    features = features.transform(pre) if pre else features
    if snap:
        features = features.withColumn("geometry", S.clean("geometry", snap, snap))
    out = shared_area(parcels, [features], keys, columns, grid)
    out = out.withColumn("proportion", clamp(F.col("area") / F.col("parcel_area"))).select(*keys, *columns, "proportion")
    return out.transform(post) if post else out


@F.arrow_udf(returnType=T.ArrayType(PIECE_TYPE))
def _as_pieces(shapes: pa.Array) -> pa.Array:
    """The trapezoids of the union of an array of geometries' parts."""
    edges = B.read_edges(shapes.values)
    offsets = np.asarray(shapes.offsets)
    counts = np.where(np.asarray(shapes.is_valid()), np.diff(offsets), 0)
    at, row = B.spread(offsets[:-1], counts), np.repeat(np.arange(len(shapes)), counts)
    n = edges.counts()[at]
    edge, owner = B.spread(edges.first[:-1][at], n), np.repeat(row, n)
    flat = edges.dim[edge] == 2
    edge, owner = edge[flat], owner[flat]
    boxes = edges.boxes()[at]
    windows = np.tile([np.inf, np.inf, -np.inf, -np.inf], (len(shapes), 1))
    for k, pick in ((0, np.minimum), (1, np.minimum), (2, np.maximum), (3, np.maximum)):
        pick.at(windows[:, k], row, boxes[:, k])
    _, rows = B.common_areas(edges.xy[edge], owner, np.zeros(len(edge), int), edges.part[edge], 1, windows, pieces=True)
    return _piece_lists(rows, 1)


def _pieces(shapes: Column) -> Column:
    """The trapezoids of the union of an array of (boxy, envelope, parts where not boxy); a box by itself is one and needs no kernel."""
    one = shapes[0]
    simple = (F.size(shapes) == 1) & one["boxy"] & (one["xmin"] < one["xmax"]) & (one["ymin"] < one["ymax"])
    ends = dict(zip(PIECE_NAMES, ("xmin", "xmax", "ymin", "ymin", "ymax", "ymax")))
    whole = F.array(F.struct(F.lit(0).alias("tag"), *[one[c].alias(n) for n, c in ends.items()]))
    parts = F.transform(shapes, lambda s: F.coalesce(s["parts"], G.rectangle(s["xmin"], s["ymin"], s["xmax"], s["ymax"])["parts"]))
    return F.when(simple, whole).otherwise(_as_pieces(F.when(~simple, parts)))


def _trapezoid(p: Column) -> Column:
    box = (p["b0"] == p["b1"]) & (p["t0"] == p["t1"])
    corners = [("x0", "b0"), ("x0", "t0"), ("x1", "t1"), ("x1", "b1"), ("x0", "b0")]
    return F.when(box, G.rectangle(p["x0"], p["b0"], p["x1"], p["t0"])).otherwise(G.polygon(F.array(F.array(*[G.vertex(p[x], p[y]) for x, y in corners]))))


def join_parcels(
    parcels: DataFrame,
    features: DataFrame,
    columns: list[str] = (),
    distance: float = 0.0,
    key: str = "id_parcel",
    grid: Grid = Grid(),
    **kw,
) -> DataFrame:
    """O1: the union of the features of each class near each parcel: (key, *columns, piece, geometry_left, geometry_right).

    A union is kept as rows: disjoint trapezoids numbered by `piece`, whose areas add up to that of
    the union.  Lines and points stay as they are, one row per feature, with a null piece.
    The features of a parcel and class are united a bounded number at a time.
    """
    columns = list(columns)
    keys = [key, *columns]
    feats = features.select(*columns, "geometry")
    one = durable(parcels.groupBy(key).agg(F.first("geometry").alias("geometry")))
    pairs = durable(sjoin(one, feats, distance, grid, copies=True, **kw).select(*keys, F.col("geometry_right").alias("geometry")))
    areal = pairs.where(F.exists(F.col("geometry")["parts"], lambda p: p["dim"] == 2))
    most = areal.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-most // FAN))
    g = F.col("geometry")
    box = ("xmin", "ymin", "xmax", "ymax")
    shape = F.struct(g["boxy"].alias("boxy"), *[g[c].alias(c) for c in box], F.when(~g["boxy"], g["parts"]).alias("parts"))
    by = [*keys, "_slice"] if slices > 1 else keys
    sliced = areal.withColumn("_slice", F.pmod(F.xxhash64(*[g[c] for c in box], F.size(g["parts"])), F.lit(slices)))
    first = sliced.groupBy(*by).agg(F.collect_list(shape).alias("shapes")).select(*by, _pieces(F.col("shapes")).alias("pieces"))
    united = first
    if slices > 1:
        united = merge_rounds(first, keys, slices, 1).withColumn("pieces", _merge_kernel(1)("pieces"))
    rows = united.select(*keys, F.posexplode("pieces").alias("piece", "_p")).select(*keys, "piece", _trapezoid(F.col("_p")).alias("geometry_right"))
    thin = G.from_parts(F.filter(g["parts"], lambda p: p["dim"] < 2))
    others = pairs.where(F.exists(g["parts"], lambda p: p["dim"] < 2)).select(*keys, F.lit(None).cast("int").alias("piece"), thin.alias("geometry_right"))
    return rows.unionByName(others).join(one.withColumnRenamed("geometry", "geometry_left"), key).select(*keys, "piece", "geometry_left", "geometry_right")


# -- pairwise ----------------------------------------------------------------


@F.arrow_udf(returnType=T.DoubleType())
def _pair_area(a: pa.Array, b: pa.Array) -> pa.Array:
    rows = np.arange(len(a))
    return pa.array(B.pair_areas(B.read_edges(a), rows, B.read_edges(b), rows))


def pair_area(a, b) -> Column:
    """Area of the intersection of two geometries."""
    a, b = G._col(a), G._col(b)
    both = a["boxy"] & b["boxy"]
    return F.when(both, G.envelope_overlap_area(a, b)).otherwise(_pair_area(F.when(~both, a["parts"]), F.when(~both, b["parts"])))


def overlap(left: DataFrame, right: DataFrame, grid: Grid = Grid(), lsuffix: str = "_left", rsuffix: str = "_right") -> DataFrame:
    """Every intersecting pair with the share of the left geometry that overlaps."""
    flat = only_boxes(left) and only_boxes(right)
    pairs = sjoin(left, right, 0.0, grid, lsuffix, rsuffix, boxes_only=flat)
    gl, gr = "geometry" + lsuffix, "geometry" + rsuffix
    area = G.envelope_overlap_area(gl, gr) if flat else pair_area(gl, gr)
    return pairs.withColumn("area", area).withColumn("proportion", clamp(F.col("area") / G.area(gl))).drop(gl, gr)


def overlay_share(a: DataFrame, b: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Area of a x b over the area of b, for two whole layers."""
    inter = overlap(a.select("geometry"), b.select("geometry"), grid).agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("shared_area"))
    whole = b.agg(F.sum(G.area("geometry")).alias("total_area"))
    # both sides are one-row totals
    return inter.crossJoin(whole).withColumn("share", F.col("shared_area") / F.col("total_area"))


def precision_recall(found: DataFrame, truth: DataFrame, by: list[str], grid: Grid = Grid()) -> DataFrame:
    """Area precision, recall and their harmonic mean per group, matched within the group."""
    by = list(by)
    flat = only_boxes(found) and only_boxes(truth)
    pairs = sjoin(found.select(*by, "geometry"), truth.select(*by, "geometry"), 0.0, grid, boxes_only=flat)
    same = pairs.where(" AND ".join(f"{c}_left = {c}_right" for c in by)) if by else pairs
    area = G.envelope_overlap_area("geometry_left", "geometry_right") if flat else pair_area("geometry_left", "geometry_right")
    inter = same.select(*[F.col(c + "_left").alias(c) for c in by], area.alias("shared"))
    rows = (
        inter.select(*by, "shared", F.lit(0.0).alias("found"), F.lit(0.0).alias("truth"))
        .unionAll(found.select(*by, F.lit(0.0), G.area("geometry"), F.lit(0.0)))
        .unionAll(truth.select(*by, F.lit(0.0), F.lit(0.0), G.area("geometry")))
    )
    sums = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("shared", "found", "truth")])
    p, r = F.try_divide("shared", "found"), F.try_divide("shared", "truth")
    return sums.withColumns({"precision": p, "recall": r}).withColumn(
        "f_score", F.try_divide(F.lit(2.0), F.try_divide(F.lit(1.0), F.col("precision")) + F.try_divide(F.lit(1.0), F.col("recall")))
    )


# -- distance bands and buffers -------------------------------------------------


def area_within_distances(
    parcels: DataFrame,
    features: DataFrame,
    columns: list[str],
    distances: list[int],
    key: str = "id_parcel",
    grid: Grid = Grid(),
    **kw,
) -> DataFrame:
    """Whole area of the features within each distance of a parcel, with the nearest one's distance.

    One join at the largest distance serves all thresholds.
    """
    pairs = sjoin(parcels.select(key, "geometry"), features.select(*columns, "geometry"), max(distances), grid, distance_col="_near", **kw)
    bands = F.array(*[F.lit(int(d)) for d in sorted(distances)])
    slim = pairs.select(key, *columns, G.area("geometry_right").alias("area"), "_near")
    return (
        slim.withColumn("distance_threshold", F.explode(F.filter(bands, lambda d: F.col("_near") <= d)))
        .groupBy(key, *columns, "distance_threshold")
        .agg(F.sum("area").alias("area"), F.floor(F.min("_near") + 0.5).cast("int").alias("minimum_distance"))
    )


QUADRANT = 8


def _capsule(a, b, radius):
    """Polygon around an edge: straight sides, arcs of QUADRANT chords per quarter turn."""
    d = b - a
    turn = np.arctan2(d[1], d[0]) if np.any(d) else 0.0
    half = np.linspace(-np.pi / 2, np.pi / 2, 2 * QUADRANT + 1)
    head = b + radius * np.column_stack([np.cos(turn + half), np.sin(turn + half)])
    tail = a + radius * np.column_stack([np.cos(turn + np.pi + half), np.sin(turn + np.pi + half)])
    ring = np.vstack([head, tail])
    return (2, [np.vstack([ring, ring[:1]])])


def buffered(g, radius: float) -> Column:
    """Polygons that together cover everything within `radius`: the geometry and a capsule per edge.

    The parts overlap; measure them with shared_area, which counts ground once.
    """

    def grow(parts):
        edges = K.edges_of(parts)
        return [p for p in parts if p[0] == 2] + [_capsule(e[:2], e[2:], radius) for e in edges]

    return S.apply_parts(g, grow) if radius > 0 else G.extract(g, 2)


def mitred(g, radius: float) -> Column:
    """Envelope grown on every side; the exact square-cornered buffer of a box."""
    g = G._col(g)
    return G.rectangle(g["xmin"] - radius, g["ymin"] - radius, g["xmax"] + radius, g["ymax"] + radius)


def buffer_proportions(
    parcels: DataFrame,
    features: DataFrame,
    buffers: list[float],
    subset: Column | None = None,
    names: tuple[str, str, str] = ("all", "subset", "other"),
    grow=buffered,
    grid: Grid = Grid(),
    key: str = "id_parcel",
) -> DataFrame:
    """Parcel share within each buffer of all features, of a subset, and of the rest, side by side.

    One pass: every feature is listed under the groups it belongs to and every
    buffer, and the group is a class of the proportion.
    """
    groups = [F.lit(names[0])]
    if subset is not None:
        groups.append(F.when(subset, F.lit(names[1])).otherwise(F.lit(names[2])))
    per_buffer = None
    for b in buffers:
        one = features.withColumn("geometry", grow("geometry", b) if b else F.col("geometry")).withColumn("_buffer", F.lit(float(b)))
        per_buffer = one if per_buffer is None else per_buffer.unionAll(one)
    listed = per_buffer.withColumn("_group", F.explode(F.array(*groups))).select("_group", "_buffer", "geometry")
    long = parcel_proportion(parcels, listed, ["_group", "_buffer"], key, grid=grid)
    wide = []
    for name in names if subset is not None else names[:1]:
        for b in buffers:
            pick = F.when((F.col("_group") == name) & (F.col("_buffer") == float(b)), F.col("proportion"))
            wide.append(F.coalesce(F.max(pick), F.lit(0.0)).alias(f"proportion_{name}_{b:g}m"))
    return long.groupBy(key).agg(*wide)


def any_and_each(parcels: DataFrame, features: DataFrame, source: str, values: list[str], key: str = "id_parcel", grid: Grid = Grid()) -> DataFrame:
    """Share covered by any source and by each source, as columns."""
    listed = features.withColumn("_source", F.explode(F.array(F.lit("any"), F.col(source)))).select("_source", "geometry")
    long = parcel_proportion(parcels, listed, ["_source"], key, grid=grid)
    each = [F.coalesce(F.max(F.when(F.col("_source") == v, F.col("proportion"))), F.lit(0.0)).alias(f"proportion_{v}") for v in ["any", *values]]
    wide = long.groupBy(key).agg(*each)
    return wide.withColumn("proportion_any", F.greatest(*[f"proportion_{v}" for v in ["any", *values]], F.lit(0.0)))


def dominant(proportions: DataFrame, column: str, key: str = "id_parcel", value: str = "proportion") -> DataFrame:
    """The class with the largest share; equal shares go to the first name."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(column).alias("c")))
    return proportions.groupBy(key).agg(best["c"].alias(column), (-best["v"]).alias(value))


def erase_by_tile(parcels: DataFrame, features: DataFrame, size: int, key: str = "id_parcel", grid: Grid = Grid()) -> DataFrame:
    """Area of each parcel in each tile outside the union of the features; tiles left empty are dropped."""
    g = F.col("geometry")
    listed = list_cells(parcels.select(key, "geometry"), float(size), names=("_tx", "_ty"))
    x0, y0 = F.col("_tx") * float(size), F.col("_ty") * float(size)
    boxed = G.rectangle(F.greatest(g["xmin"], x0), F.greatest(g["ymin"], y0), F.least(g["xmax"], x0 + size), F.least(g["ymax"], y0 + size))
    general = S.clip_to_box(F.when(~g["boxy"], g), x0, y0, x0 + size, y0 + size)
    chips = listed.select(
        key,
        (F.col("_tx") * size).alias("tile_x"),
        (F.col("_ty") * size).alias("tile_y"),
        F.when(g["boxy"], boxed).otherwise(general).alias("geometry"),
    ).where(~G.is_empty("geometry"))
    keys = [key, "tile_x", "tile_y"]
    taken = shared_area(chips, [features], keys, [], grid).select(*keys, "area")
    whole = chips.select(*keys, G.area("geometry").alias("whole")).where("whole > 0")
    return (
        whole.join(taken, keys, "left")
        .select(*keys, (F.col("whole") - F.coalesce("area", F.lit(0.0))).alias("area"))
        .where(F.col("area") > 1e-9)
    )


def self_overlap(parcels: DataFrame, key: str = "id_parcel", grid: Grid = Grid()) -> DataFrame:
    """Per parcel, how many others overlap it with positive area, and the summed share."""
    side = parcels.select(key, "geometry")
    pairs = overlap(side, side, grid).where(F.col(key + "_left") != F.col(key + "_right")).where("area > 0")
    return pairs.groupBy(F.col(key + "_left").alias(key)).agg(
        F.count("*").alias("n_overlaps"), F.sum("area").alias("overlap_area"), F.sum("proportion").alias("proportion")
    )


# -- lengths inside areas --------------------------------------------------------


@F.arrow_udf(returnType=T.DoubleType())
def _length_inside(lines: pa.Array, areas: pa.Array) -> pa.Array:
    left, right = B.read_edges(lines), B.read_edges(areas)
    row = np.repeat(np.arange(len(left)), left.counts())[left.dim == 1]
    xy = left.xy[left.dim == 1]
    who, t0, t1 = B.spans_inside(xy, right, row)
    run = np.hypot(xy[:, 2] - xy[:, 0], xy[:, 3] - xy[:, 1])
    return pa.array(np.bincount(row[who], (t1 - t0) * run[who], len(left)))


def length_inside(lines: DataFrame, areas: DataFrame, by: list[str], grid: Grid = Grid()) -> DataFrame:
    """Total length of line features inside the areas of each name."""
    boxes_only = only_boxes(lines) and only_boxes(areas)
    pairs = sjoin(areas.select(*by, "geometry"), lines.select("geometry"), 0.0, grid, boxes_only=boxes_only)
    a, b = F.col("geometry_left"), F.col("geometry_right")
    w = F.greatest(F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"]), F.lit(0.0))
    h = F.greatest(F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"]), F.lit(0.0))
    both = a["boxy"] & b["boxy"]
    if boxes_only:
        run = w + h
    else:
        run = F.when(both, w + h).otherwise(_length_inside(F.when(~both, b["parts"]), F.when(~both, a["parts"])))
    return pairs.withColumn("_m", run).groupBy(*by).agg(F.sum("_m").alias("length"), F.count("*").alias("n"))

