"""Linear referencing of boundaries.

The part of a straight edge within b metres of another edge is one interval of
the edge's parameter, because the distance to a segment is convex along a
line.  Its ends have a closed form, so every step up to the final sum is column
arithmetic; only the inside of a polygon that is not a box asks a kernel.

A pair of edges meets in one grid cell, since its interval does not depend on the cell.
Where every feature equals its envelope, a pair of an edge and a feature has one
interval, found from whole Arrow batches.  Otherwise features are met edge by edge, and
the intervals of an edge are merged inside the grid cell where the join found them, which
bounds each merge by the cell.  Then intervals are merged over cells, dealt out by segment.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from landgrain.functions import batches as B
from landgrain.functions import geometry as G
from landgrain.functions import kernels as K
from landgrain.functions import rings as R
from landgrain.functions import shapes as S
from landgrain.operators.overlap import PIECE_VERTICES
from landgrain.operators.spatial_join import KEY, Grid, candidates, only_boxes, sjoin, unbroadcast

SPANS_TYPE = T.ArrayType(T.StructType([T.StructField("t0", T.DoubleType()), T.StructField("t1", T.DoubleType())]))
BUFFERS = [0, 2, 4, 8, 12, 24]


# -- segments -------------------------------------------------------------------


def segmentise_boundary(parcels: DataFrame, key: str = "id_parcel", tolerance: float = 10.0, longest: float = 50.0) -> DataFrame:
    """Parcel outlines cut into segments, with a key made from parcel and position."""
    rings = parcels.select(key, F.posexplode(G.boundary("geometry")["parts"]).alias("ring", "part"))
    lines = rings.select(key, "ring", G.from_parts(F.array("part")).alias("geometry"))
    pieces = lines.select(key, "ring", F.posexplode(S.segmentise("geometry", tolerance, longest)).alias("pos", "geometry"))
    return pieces.select(
        F.xxhash64(key, "ring", "pos").alias("id_boundary"), key, "ring", "pos", "geometry", G.length("geometry").alias("m")
    )


def dump_parts(df: DataFrame) -> DataFrame:
    """One row per part."""
    others = [c for c in df.columns if c != "geometry"]
    return df.select(*others, F.posexplode("geometry.parts").alias("part", "p")).select(
        *others, "part", G.from_parts(F.array("p")).alias("geometry")
    )


def dump_points(df: DataFrame) -> DataFrame:
    """One row per vertex, in order."""
    others = [c for c in df.columns if c != "geometry"]
    return (
        df.select(*others, F.posexplode("geometry.parts").alias("part", "p"))
        .select(*others, "part", F.posexplode("p.rings").alias("ring", "r"))
        .select(*others, "part", "ring", F.posexplode("r").alias("pos", "v"))
        .select(*others, "part", "ring", "pos", "v.x", "v.y")
    )


def dump_edges(df: DataFrame) -> DataFrame:
    """Edges (x0, y0, x1, y1) of lines and rings; a point is an edge of zero length."""
    others = [c for c in df.columns if c != "geometry"]
    rings = df.select(*others, F.posexplode("geometry.parts").alias("part", "p")).select(
        *others, "part", F.col("p.dim").alias("dim"), F.posexplode("p.rings").alias("ring", "r")
    )
    last = F.greatest(F.size("r") - 1, F.lit(1))
    steps = rings.select("*", F.explode(F.sequence(F.lit(0), last - 1)).alias("pos"))
    a = F.get("r", F.col("pos"))
    b = F.coalesce(F.get("r", F.col("pos") + 1), a)
    return steps.select(
        *others, "part", "dim", "ring", "pos", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")
    )


def lead_edges(points: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Consecutive vertices of a vertex table paired by LEAD; the last vertex drops out."""
    w = W.partitionBy(*keys).orderBy(order)
    paired = points.withColumns({"x1": F.lead("x").over(w), "y1": F.lead("y").over(w)})
    return paired.where("x1 IS NOT NULL").withColumnsRenamed({"x": "x0", "y": "y0"})


# -- intervals of one edge near another -------------------------------------------


def _band(offset, slope, lo, hi) -> tuple[Column, Column]:
    """Interval of t where lo <= offset + t * slope <= hi; unbounded or null for zero slope."""
    inf = F.lit(float("inf"))
    inside = (offset >= lo) & (offset <= hi)
    first = F.when(slope > 0, (lo - offset) / slope).when(slope < 0, (hi - offset) / slope).when(inside, -inf)
    last = F.when(slope > 0, (hi - offset) / slope).when(slope < 0, (lo - offset) / slope).when(inside, inf)
    return first, last


def _measure_pairs(pairs: DataFrame) -> DataFrame:
    """What the interval of a pair of edges needs before the buffer is known, in steps that name shared terms.

    Segment edge A + t d in _sx0.._sy1, feature edge from C to E in _fx0.._fy1.
    """
    c = F.col
    pairs = pairs.withColumns(
        {
            "_dx": c("_sx1") - c("_sx0"),
            "_dy": c("_sy1") - c("_sy0"),
            "_fl": F.sqrt((c("_fx1") - c("_fx0")) * (c("_fx1") - c("_fx0")) + (c("_fy1") - c("_fy0")) * (c("_fy1") - c("_fy0"))),
            "_px": c("_sx0") - c("_fx0"),
            "_py": c("_sy0") - c("_fy0"),
            "_qx": c("_sx0") - c("_fx1"),
            "_qy": c("_sy0") - c("_fy1"),
        }
    )
    pairs = pairs.withColumns(
        {"_ux": F.when(c("_fl") > 0, (c("_fx1") - c("_fx0")) / c("_fl")), "_uy": F.when(c("_fl") > 0, (c("_fy1") - c("_fy0")) / c("_fl"))}
    )
    return pairs.withColumns(
        {
            "_along0": c("_ux") * c("_px") + c("_uy") * c("_py"),
            "_along1": c("_ux") * c("_dx") + c("_uy") * c("_dy"),
            "_across0": c("_ux") * c("_py") - c("_uy") * c("_px"),
            "_across1": c("_ux") * c("_dy") - c("_uy") * c("_dx"),
            "_aa": c("_dx") * c("_dx") + c("_dy") * c("_dy"),
            "_cb": c("_dx") * c("_px") + c("_dy") * c("_py"),
            "_cc": c("_px") * c("_px") + c("_py") * c("_py"),
            "_eb": c("_dx") * c("_qx") + c("_dy") * c("_qy"),
            "_ec": c("_qx") * c("_qx") + c("_qy") * c("_qy"),
        }
    )


def _near_interval(pairs: DataFrame) -> DataFrame:
    """Columns _lo, _hi: the part of t in [0, 1] within `buffer` of the feature edge.

    The reach of an edge is a band along it and a disc at either end; together
    they are convex, so the interval is the hull of the three.
    """
    c, b = F.col, F.col("buffer")
    l0, l1 = _band(c("_along0"), c("_along1"), F.lit(0.0), c("_fl"))
    x0, x1 = _band(c("_across0"), c("_across1"), -b, b)
    pairs = pairs.withColumns(
        {
            "_l0": l0, "_l1": l1, "_x0": x0, "_x1": x1,
            "_cd": c("_cb") * c("_cb") - c("_aa") * (c("_cc") - b * b),
            "_ed": c("_eb") * c("_eb") - c("_aa") * (c("_ec") - b * b),
        }
    )
    pairs = pairs.withColumns(
        {
            "_b0": F.greatest("_l0", "_x0"),
            "_b1": F.least("_l1", "_x1"),
            "_cr": F.when((c("_cd") >= 0) & (c("_aa") > 0), F.sqrt("_cd")),
            "_er": F.when((c("_ed") >= 0) & (c("_aa") > 0), F.sqrt("_ed")),
        }
    )
    band = c("_l0").isNotNull() & c("_x0").isNotNull() & (c("_b0") <= c("_b1"))
    # least and greatest skip nulls, so the hull is over the pieces that exist
    return pairs.withColumns(
        {
            "_lo": F.least(F.when(band, c("_b0")), (-c("_cb") - c("_cr")) / c("_aa"), (-c("_eb") - c("_er")) / c("_aa")),
            "_hi": F.greatest(F.when(band, c("_b1")), (-c("_cb") + c("_cr")) / c("_aa"), (-c("_eb") + c("_er")) / c("_aa")),
        }
    )


def _box_interval(pairs: DataFrame, g: Column) -> DataFrame:
    """Columns _lo, _hi: the part of t in [0, 1] inside the envelope of g (closed)."""
    x0, x1 = _band(F.col("_sx0"), F.col("_dx"), g["xmin"], g["xmax"])
    y0, y1 = _band(F.col("_sy0"), F.col("_dy"), g["ymin"], g["ymax"])
    pairs = pairs.withColumns({"_bx0": x0, "_bx1": x1, "_by0": y0, "_by1": y1})
    ok = F.col("_bx0").isNotNull() & F.col("_by0").isNotNull()
    area = F.col("_area")
    return pairs.withColumns(
        {
            "_lo": F.when(area & ok, F.greatest("_bx0", "_by0")).when(~area, F.col("_lo")),
            "_hi": F.when(area & ok, F.least("_bx1", "_by1")).when(~area, F.col("_hi")),
        }
    )


NEAR_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("buffer", "t0", "t1")]))


def _inside_band(at, step, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Interval of t where low <= at + t * step <= high; inf to -inf where there is none."""
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = (low - at) / step, (high - at) / step
    always = (low <= at) & (at <= high)
    first = np.where(step != 0, np.minimum(a, b), np.where(always, -np.inf, np.inf))
    return first, np.where(step != 0, np.maximum(a, b), np.where(always, np.inf, -np.inf))


def _near_box(line: np.ndarray, box: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
    """The part of t in [0, 1] of every line within b of its box, first > last where there is none.

    What is near a box is the box grown along either axis and a disc at every corner;
    together they are convex, so the interval is the hull of the six.
    """
    x, y, dx, dy = line[0], line[1], line[2] - line[0], line[3] - line[1]
    lows, highs = [], []
    for gx, gy in ((b, 0.0), (0.0, b)):
        x0, x1 = _inside_band(x, dx, box[0] - gx, box[2] + gx)
        y0, y1 = _inside_band(y, dy, box[1] - gy, box[3] + gy)
        low, high = np.maximum(x0, y0), np.minimum(x1, y1)
        lows.append(np.where(low <= high, low, np.inf))
        highs.append(np.where(low <= high, high, -np.inf))
    square = dx * dx + dy * dy
    for cx, cy in ((0, 1), (0, 3), (2, 1), (2, 3)):
        px, py = x - box[cx], y - box[cy]
        along = dx * px + dy * py
        under = along * along - square * (px * px + py * py - b * b)
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(under)
            low, high = (-along - root) / square, (-along + root) / square
        ok = (under >= 0) & (square > 0)
        lows.append(np.where(ok, low, np.inf))
        highs.append(np.where(ok, high, -np.inf))
    return np.maximum(np.minimum.reduce(lows), 0.0), np.minimum(np.maximum.reduce(highs), 1.0)


def _box_spans(buffers: list[float]):
    @F.arrow_udf(returnType=NEAR_TYPE)
    def run(
        sx0: pa.Array, sy0: pa.Array, sx1: pa.Array, sy1: pa.Array, xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array, poly: pa.Array
    ) -> pa.Array:
        """Intervals (buffer, t0, t1) of every edge near its box; boxes without area have no inside."""
        line, box = ([c.to_numpy(zero_copy_only=False).astype(float) for c in cs] for cs in ((sx0, sy0, sx1, sy1), (xmin, ymin, xmax, ymax)))
        areal = np.asarray(poly.to_numpy(zero_copy_only=False), bool)
        rows, found = [], []
        for b in buffers:
            first, last = _near_box(line, box, b)
            some = np.flatnonzero((last > first) & (areal | (b > 0)))
            rows.append(some)
            found.append(np.column_stack([np.full(len(some), float(b)), first[some], last[some]]))
        row, values = np.concatenate(rows), np.concatenate(found)
        order = np.argsort(row, kind="stable")
        ends = np.searchsorted(row[order], np.arange(len(areal) + 1)).astype(np.int32)
        columns = [pa.array(np.ascontiguousarray(values[order, k])) for k in range(3)]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=["buffer", "t0", "t1"]))

    return run


SIZES_TYPE = T.StructType([T.StructField("vertices", T.ArrayType(T.IntegerType())), T.StructField("areas", T.ArrayType(T.DoubleType()))])


def _piece_sizes(most: int):
    @F.arrow_udf(returnType=SIZES_TYPE)
    def run(parts: pa.Array) -> pa.Array:
        """Vertices and areas of the pieces of every geometry; all single rings of a batch are cut at once."""
        rows = K.PartsReader(parts)
        easy, xy, first = R.read(rows, 2, 1)
        rest = np.setdiff1d(np.arange(len(rows)), easy, assume_unique=True)
        cuts = [(i, cut) for i in rest.tolist() if (p := rows.parts(i)) for cut in K.halve_until(p, most)]
        owner = np.array([i for i, _ in cuts], np.int64)
        vertices = np.array([K.count_vertices(c) for _, c in cuts], np.int64)
        areas = np.array([K.parts_area(c) for _, c in cuts], float)
        if len(easy):
            xy, first, ring = R.halve_until(xy, first, most)
            owner, vertices = np.append(owner, np.asarray(easy)[ring]), np.append(vertices, np.diff(first))
            areas = np.append(areas, np.abs(R.areas(xy, first)))
        order = np.argsort(owner, kind="stable")
        ends = pa.array(np.searchsorted(owner[order], np.arange(len(rows) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x[order], t)) for x, t in ((vertices, pa.int32()), (areas, pa.float64()))]
        return pa.StructArray.from_arrays(lists, names=["vertices", "areas"])

    return run


@F.udtf(returnType="id string, piece int, vertices int, area double")
class CutPieces:
    """Table function over (id, vertices and areas of a geometry's pieces), one partition per id: a row for every piece.

    Pieces of one id are numbered across its rows, which the call orders.
    """

    def __init__(self):
        self.piece = 0

    def eval(self, row):
        key = row["id"]
        for vertices, area in zip(row["vertices"], row["areas"]):
            yield key, self.piece, vertices, area
            self.piece += 1


def cut_pieces(shapes: DataFrame, key: str, order: str, most: int = 256) -> DataFrame:
    """(id, piece, vertices, area) of the pieces of every geometry, by a table function partitioned by key.

    Geometries are cut by the batch; only the sizes of their pieces go through the table function row by row.
    """
    if most < 8:
        raise ValueError("a piece needs room for 8 vertices: halves of four-sided pieces never get smaller")
    # dealt out first, since a small file can hold many rows
    dealt = shapes.select(F.col(key).cast("string").alias("id"), F.col(order).alias("at"), F.col("geometry")).repartition("id")
    sizes = dealt.select("id", "at", _piece_sizes(most)(F.col("geometry")["parts"]).alias("cut"))
    table = sizes.select("id", "at", "cut.vertices", "cut.areas")
    return CutPieces(table.asTable().partitionBy("id").orderBy("at"))


@F.arrow_udf(returnType=SPANS_TYPE)
def _shape_spans(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, parts: pa.Array) -> pa.Array:
    lines = np.column_stack([c.to_numpy(zero_copy_only=False) for c in (x0, y0, x1, y1)]).astype(float)
    who, t0, t1 = B.spans_inside(lines, B.read_edges(parts), np.arange(len(lines)))
    ends = np.searchsorted(who, np.arange(len(lines) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(t0), pa.array(t1)], names=["t0", "t1"]))


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Union of intervals (t0, t1) per key as disjoint intervals: gaps and islands."""
    w = W.partitionBy(*keys).orderBy("t0", "t1")
    reach = F.max("t1").over(w.rowsBetween(W.unboundedPreceding, -1))
    starts = spans.withColumn("_new", F.when(reach.isNull() | (F.col("t0") > reach), F.lit(1)).otherwise(F.lit(0)))
    isles = starts.withColumn("_isle", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return isles.groupBy(*keys, "_isle").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1")).drop("_isle")


def _bounds(x0, y0, x1, y1) -> Column:
    """A geometry of which only the envelope is needed."""
    low, high = [F.least(x0, x1), F.least(y0, y1)], [F.greatest(x0, x1), F.greatest(y0, y1)]
    ends = dict(zip(("xmin", "ymin", "xmax", "ymax"), [*low, *high]))
    return F.struct(F.lit(None).cast(G.PARTS).alias("parts"), *[v.alias(k) for k, v in ends.items()], F.lit(True).alias("boxy"))


def _feature_edges(feats: DataFrame, cols: list[str], cut: bool = False) -> DataFrame:
    """Every edge of the features as a row, and every polygon once more as a whole, or in pieces of few vertices."""
    outline = dump_edges(feats).select(
        *cols,
        (F.col("dim") == 2).alias("_poly"),
        F.lit(False).alias("_area"),
        _bounds("x0", "y0", "x1", "y1").alias("geometry"),
        *[F.col(c).alias(f"_f{c}") for c in ("x0", "y0", "x1", "y1")],
    )
    polygons = feats.where(F.exists(F.col("geometry")["parts"], lambda p: p["dim"] == 2)).select(
        *cols,
        F.lit(True).alias("_poly"),
        F.lit(True).alias("_area"),
        (F.explode(S.pieces_of("geometry", PIECE_VERTICES)) if cut else F.col("geometry")).alias("geometry"),
        *[F.lit(None).cast("double").alias(f"_f{c}") for c in ("x0", "y0", "x1", "y1")],
    )
    return outline.unionAll(polygons)


def _feature_boxes(feats: DataFrame, cols: list[str]) -> DataFrame:
    """Features that equal their envelopes, a row each, with the columns of _feature_edges."""
    g = F.col("geometry")
    return feats.select(
        *cols,
        F.exists(g["parts"], lambda p: p["dim"] == 2).alias("_poly"),
        F.lit(True).alias("_area"),
        _bounds(g["xmin"], g["ymin"], g["xmax"], g["ymax"]).alias("geometry"),
        *[F.lit(None).cast("double").alias(f"_f{c}") for c in ("x0", "y0", "x1", "y1")],
    )


def _spans_of_edges(pairs: DataFrame, kept: list[str], buffers: list[float], g: Column, shapes: bool) -> DataFrame:
    """Intervals of the pairs of segment edges with feature edges and polygons; `shapes` says that some polygon is no box."""
    shaped = F.col("_area") & ~g["boxy"]
    spread = _measure_pairs(pairs).withColumn("run", F.sqrt("_aa"))
    # a pair farther apart than a buffer has no interval there; the inside of a polygon does not depend on the buffer
    wanted = F.filter(
        F.array(*[F.lit(float(b)) for b in buffers]),
        lambda b: (b >= F.col("_reach")) & ((b > 0) | F.col("_poly")) & (~F.col("_area") | (F.col("_reach") == 0)),
    )
    boxed = _box_interval(_near_interval(spread.withColumn("buffer", F.explode(wanted))), g)
    kept = [*kept, "run", "buffer"]
    # an edge beside the segment has no interval; greatest and least would read its null as all of it
    low = F.when(F.col("_lo").isNotNull(), F.greatest("_lo", F.lit(0.0)))
    high = F.when(F.col("_hi").isNotNull(), F.least("_hi", F.lit(1.0)))
    closed = F.array(F.struct(low.alias("t0"), high.alias("t1")))
    if shapes:
        hard = _shape_spans(*[F.col(f"_s{c}") for c in ("x0", "y0", "x1", "y1")], F.when(shaped, g["parts"]))
        spans = boxed.withColumn("_hard", hard).select(*kept, F.inline(F.when(shaped, F.col("_hard")).otherwise(closed)))
    else:
        spans = boxed.select(*kept, low.alias("t0"), high.alias("t1"))
    return spans.where(F.col("t1") > F.col("t0"))


def buffer_spans(
    segments: DataFrame,
    features: DataFrame,
    columns: list[str],
    buffers: list[float],
    segment_key: str = "id_boundary",
    grid: Grid = Grid(),
    exclude: tuple[str, str] | None = None,
    deal: list[str] = (),
) -> DataFrame:
    """Disjoint intervals (segment, edge, *columns, buffer, t0, t1, run) of boundary within each buffer.

    At buffer 0 only polygons count: a line or point has no area to lie in.
    `exclude` names a segment and a feature column whose equal values do not
    match (a parcel's own outline).  The rows come dealt out by the segment and
    the columns `deal`, so what follows by these is not shuffled again.
    """
    columns = list(columns)
    ex_seg, ex_feat = exclude or (None, None)
    far = float(max(buffers))
    seg_cols = [segment_key, *([ex_seg] if ex_seg else [])]
    edges = dump_edges(segments.select(*[F.col(c) for c in seg_cols], "geometry"))
    left = edges.select(
        F.col(segment_key).alias("_seg"),
        *([F.col(ex_seg).alias("_own")] if ex_seg else []),
        F.struct("part", "ring", "pos").alias("_edge"),
        _bounds("x0", "y0", "x1", "y1").alias("geometry"),
        *[F.col(c).alias(f"_s{c}") for c in ("x0", "y0", "x1", "y1")],
    )
    feat_cols = list(dict.fromkeys([*columns, *([ex_feat] if ex_feat else [])]))
    whole = features.select(*feat_cols, "geometry")
    boxes = only_boxes(whole)
    shapes = not boxes and not only_boxes(whole.where(F.exists(F.col("geometry")["parts"], lambda p: p["dim"] == 2)))
    right = _feature_boxes(whole, feat_cols) if boxes else _feature_edges(whole, feat_cols, shapes)
    pairs = candidates(left, right, grid, far, once=True, copies=True)
    if exclude:
        pairs = pairs.where(F.col("_own") != F.col(ex_feat))
    gl, gr = F.col("geometry_left"), F.col("geometry_right")
    pairs = pairs.withColumn("_reach", G.envelope_distance(gl, gr)).where(F.col("_reach") <= far)
    kept = [*KEY, "_seg", "_edge", *columns]
    if boxes:
        near = _box_spans([float(b) for b in buffers])(*[F.col(f"_s{c}") for c in ("x0", "y0", "x1", "y1")], *[gr[c] for c in ("xmin", "ymin", "xmax", "ymax")], F.col("_poly"))
        dx, dy = F.col("_sx1") - F.col("_sx0"), F.col("_sy1") - F.col("_sy0")
        spans = pairs.select(*kept, F.sqrt(dx * dx + dy * dy).alias("run"), F.inline(near))
    else:
        spans = _spans_of_edges(pairs, kept, buffers, gr, shapes)
    keys = ["_seg", "_edge", "run", *columns, "buffer"]
    if not boxes:  # a feature makes many intervals of an edge; a box makes one, and merging it by cells would cost two shuffles
        spans = merge_spans(spans, [*KEY, *keys])
    dealt = spans.select(*keys, "t0", "t1").repartition("_seg", *deal)
    return merge_spans(dealt, keys).withColumnRenamed("_seg", segment_key)


def boundary_proportion(
    segments: DataFrame,
    features: DataFrame,
    columns: list[str] = (),
    buffers: list[float] = BUFFERS,
    parcels: DataFrame | None = None,
    key: str = "id_parcel",
    segment_key: str = "id_boundary",
    grid: Grid = Grid(),
    exclude: tuple[str, str] | None = None,
) -> DataFrame:
    """O3: share of every boundary segment within each buffer of the features, one column per buffer.

    With `parcels`, every segment of a parcel that has a feature within the
    largest buffer is listed, with zeros where nothing is near; without, only
    segments with something near.
    """
    columns = list(columns)
    spans = buffer_spans(segments, features, columns, buffers, segment_key, grid, exclude, deal=columns if parcels is not None else [])
    covered = spans.groupBy(segment_key, *columns).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("buffer") == float(b), (F.col("t1") - F.col("t0")) * F.col("run"))), F.lit(0.0)).alias(f"_m{b:g}")
            for b in buffers
        ]
    )
    base = segments.select(segment_key, key, "m")
    if parcels is None:
        joined = base.join(unbroadcast(covered), segment_key)
    else:
        feats = features.select(*columns, *([exclude[1]] if exclude and exclude[1] not in columns else []), "geometry")
        met = sjoin(parcels.select(F.col(key).alias("_parcel"), "geometry"), feats, float(max(buffers)), grid)
        if exclude:
            met = met.where(F.col("_parcel") != F.col(exclude[1]))
        met = met.select(F.col("_parcel").alias(key), *columns).distinct()
        joined = base.join(unbroadcast(met), key).join(unbroadcast(covered), [segment_key, *columns], "left")
    share = [
        F.least(F.greatest(F.coalesce(F.col(f"_m{b:g}") / F.col("m"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0)).alias(f"proportion_{b:g}m")
        for b in buffers
    ]
    return joined.select(segment_key, key, "m", *columns, *share)


def boundary_adjacency(
    parcels: DataFrame, segments: DataFrame, buffers: list[float] = BUFFERS, key: str = "id_parcel", grid: Grid = Grid()
) -> DataFrame:
    """O3 against the other parcels: share of each segment near each neighbouring parcel."""
    other = parcels.select(F.col(key).alias(key + "_right"), "geometry")
    return boundary_proportion(segments, other, [key + "_right"], buffers, parcels, key, grid=grid, exclude=(key, key + "_right"))


# -- merging boundary tables ---------------------------------------------------


def use_flags(shares: DataFrame, uses: list[str], threshold: str = "0.5 < proportion_12m", use: str = "use", segment_key: str = "id_boundary") -> DataFrame:
    """One row per segment with a flag per use, from shares listed by use; null where a use was never near."""
    flagged = shares.withColumn("_f", F.expr(threshold))
    return flagged.groupBy(segment_key).agg(*[F.max(F.when(F.col(use) == u, F.col("_f"))).alias(f"bool_{u}") for u in uses])


def merge_boundaries(
    segments: DataFrame,
    adjacency: DataFrame,
    flags: DataFrame,
    uses: list[str],
    threshold: str = "0.5 < proportion_12m",
    key: str = "id_parcel",
    segment_key: str = "id_boundary",
    mode: str = "segments",
) -> DataFrame:
    """Boundary length per parcel by adjacency and by use (hedgerow, relict, wall, water).

    Shared boundary counts half in the m_adj columns.  mode="segments" starts
    from all segments and reads an unknown flag as false; mode="outer" takes
    parcel and length from the adjacency table, and drops segments whose
    adjacency is unknown from the m_adj sums.
    """
    adj = adjacency.withColumn("_f", F.expr(threshold)).groupBy(segment_key).agg(
        F.first(key).alias(key), F.first("m").alias("m"), F.max("_f").alias("bool_adjacency")
    )
    named = [f"bool_{u}" for u in uses]
    if mode == "segments":
        base = segments.select(segment_key, key, "m")
        table = base.join(unbroadcast(adj.drop(key, "m")), segment_key, "left").join(unbroadcast(flags), segment_key, "left").na.fill(False, ["bool_adjacency", *named])
    else:
        table = adj.join(unbroadcast(flags), segment_key, "outer")
    combined = {f"bool_{u}": F.col(f"bool_{u}") for u in uses}
    if {"wall", "hedgerow"} <= set(uses):
        combined["bool_wall_or_hedgerow"] = F.col("bool_hedgerow") | F.col("bool_wall")
        if "water" in uses:
            combined["bool_wall_or_hedgerow_or_water"] = combined["bool_wall_or_hedgerow"] | F.col("bool_water")
    table = table.withColumns(combined)
    single = F.col("m") * (2 - F.col("bool_adjacency").cast("double")) / 2
    aggs = [F.sum("m").alias("m")]
    aggs += [F.sum(F.col("m") * F.col(f).cast("double")).alias(f.replace("bool_", "m_")) for f in combined]
    aggs += [F.sum(single).alias("m_adj")]
    aggs += [F.sum(single * F.col(f).cast("double")).alias(f.replace("bool_", "m_adj_")) for f in combined]
    out = table.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    rest = reduce(lambda acc, n: acc - F.coalesce(F.col(f"m_adj_{n}"), F.lit(0.0)), uses, F.coalesce("m_adj", F.lit(0.0)))
    return out.withColumn("m_adj_none", rest).na.fill(0)


# -- dividing a boundary between uses ----------------------------------------------


def divide_by_use(spans: DataFrame, uses: list[str], segments: DataFrame, use_col: str = "use", segment_key: str = "id_boundary") -> DataFrame:
    """Cut every segment at the ends of all use intervals and flag each piece with the uses on it.

    An event sweep: +1 where a use starts, -1 where it ends; running sums give
    the uses that are active on the piece up to the next event.
    """
    keys = [segment_key, "_edge", "run"]
    step = [F.when(F.col(use_col) == u, F.col("_d")).otherwise(F.lit(0)).alias(u) for u in uses]
    starts = spans.select(*keys, F.col("t0").alias("t"), use_col, F.lit(1).alias("_d"))
    ends = spans.select(*keys, F.col("t1").alias("t"), use_col, F.lit(-1).alias("_d"))
    events = starts.unionAll(ends).select(*keys, "t", *step)
    edges = dump_edges(segments.select(segment_key, "geometry")).select(
        segment_key,
        F.struct("part", "ring", "pos").alias("_edge"),
        F.sqrt(F.pow(F.col("x1") - F.col("x0"), 2) + F.pow(F.col("y1") - F.col("y0"), 2)).alias("run"),
    )
    zero = [F.lit(0).alias(u) for u in uses]
    frame = edges.select(*keys, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("t"), *zero)
    marks = events.unionAll(frame).groupBy(*keys, "t").agg(*[F.sum(u).alias(u) for u in uses])
    w = W.partitionBy(*keys).orderBy("t")
    live = w.rowsBetween(W.unboundedPreceding, 0)
    pieces = marks.select(
        *keys, F.col("t").alias("t0"), F.lead("t").over(w).alias("t1"), *[(F.sum(u).over(live) > 0).alias(f"bool_{u}") for u in uses]
    )
    return pieces.where("t1 > t0").withColumn("m", (F.col("t1") - F.col("t0")) * F.col("run"))


def allocate_by_priority(pieces: DataFrame, uses: list[str]) -> DataFrame:
    """Each piece goes to the first use on it, in order; the rest stays free."""
    chosen = reduce(lambda acc, u: acc.when(F.col(f"bool_{u}"), F.lit(u)), uses[1:], F.when(F.col(f"bool_{uses[0]}"), F.lit(uses[0])))
    return pieces.withColumn("use", chosen.otherwise(F.lit("none")))


def classify_relict(lengths: DataFrame, m: str = "m", woody: str = "m_woody", shortest: float = 2.0, share: float = 0.3) -> DataFrame:
    """Segments longer than `shortest` whose woody share exceeds `share`."""
    return lengths.withColumn("is_relict", (F.col(m) > shortest) & (F.col(woody) / F.col(m) > share))


def single_sided(lines: DataFrame, neighbours: DataFrame, buffers: list[float], line_key: str, exclude: tuple[str, str], grid: Grid = Grid(), over: float = 0.95) -> DataFrame:
    """Share of each line overlapped by neighbours per buffer, and its length counted half where that exceeds `over`."""
    spans = buffer_spans(lines, neighbours, [], buffers, line_key, grid, exclude)
    m = G.length("geometry")
    covered = spans.groupBy(line_key).agg(
        *[F.sum(F.when(F.col("buffer") == float(b), (F.col("t1") - F.col("t0")) * F.col("run"))).alias(f"_c{b:g}") for b in buffers]
    )
    base = lines.select(line_key, m.alias("m")).join(unbroadcast(covered), line_key, "left")
    out = [line_key, "m"]
    for b in buffers:
        p = F.least(F.coalesce(F.col(f"_c{b:g}") / F.col("m"), F.lit(0.0)), F.lit(1.0))
        out += [p.alias(f"proportion_{b:g}m"), F.when(p > over, F.col("m") / 2).otherwise(F.col("m")).alias(f"m_counted_{b:g}m")]
    return base.select(*out)
