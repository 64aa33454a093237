"""Spatial joins as equi-joins on grid cells.

Each geometry is listed under every grid cell its envelope touches; rows that
share a cell become candidates, and the exact test runs on candidates only.
A pair that shares several cells is emitted from one of them: the cell that
holds the lower-left corner of the common envelope.

Cell sizes.  Every geometry has a level of its own, the lowest whose cells are at
least a quarter of its size; cells double from level to level, so no geometry
touches more than a few dozen cells.  A pair meets on the coarser of its two
levels: the finer side is listed there too, but only for the levels the other
side has.  Which levels a layer has is one small aggregate over both sides.
Aggregates that add up over cells need the cells of one left row to be disjoint,
so there a pair always meets on the level of the left geometry.

Crowded cells.  Cell loads are counted first (one aggregate over envelope
columns).  When no cell is crowded the join uses cells as they are.  Otherwise
  * cells holding many small geometries are cut into quarters, repeatedly,
    down to the typical geometry size, so the pieces stay disjoint in space;
  * what is still crowded is laid out as a block matrix: left rows get one of
    `sl` slices and meet all `sr` right slices, and the other way round, so
    every pair meets exactly once and no task holds more than about
    `crowd` x `crowd` rows.
The table of crowded cells grows with the data (at most listed rows / crowd
entries), so it is joined without a broadcast hint.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from landgrain.functions import geometry as G
from landgrain.functions import shapes as S

MAX_LEVEL = 8
"""Halvings of a crowded cell."""

SPAN = 4
"""Cells of its own level that a geometry may be wide."""


@dataclass(frozen=True)
class Grid:
    """cell: side of a grid cell in metres, None to derive it from the data.
    crowd: rows of one side a cell may hold before it is cut or sliced, None to trust the data.
    """

    cell: float | None = None
    crowd: int | None = 20_000
    quarter: bool = True


CELL_KEY = ["_base", "_level", "_cx", "_cy"]
KEY = [*CELL_KEY, "_i", "_j"]


def suffix_clashes(left: DataFrame, right: DataFrame, lsuffix: str = "_left", rsuffix: str = "_right") -> tuple[DataFrame, DataFrame]:
    """Rename the columns both sides have."""
    clash = [c for c in left.columns if c in right.columns]
    return (
        left.withColumnsRenamed({c: c + lsuffix for c in clash}),
        right.withColumnsRenamed({c: c + rsuffix for c in clash}),
    )


def unbroadcast(df: DataFrame) -> DataFrame:
    """One side of a join that is sorted, not broadcast.

    Spark's estimate of a side is the size of its files.  Rows that expressions and
    generators have made of them take many times that, and a broadcast holds them on the driver.
    """
    return df.hint("merge")


def choose_cell(left: DataFrame, right: DataFrame, distance: float = 0.0) -> float:
    """Twice the median envelope side of the layer with the larger geometries; larger ones go to higher levels."""

    def typical(df):
        g = F.col("geometry")
        return df.agg(F.percentile_approx(F.greatest(g["xmax"] - g["xmin"], g["ymax"] - g["ymin"]), 0.5).alias("s"))

    s = typical(left).unionAll(typical(right)).agg(F.max("s")).first()[0]
    return max(2.0 * (s or 0.0), 2.0 * distance, 1.0)


def _own_level(cell: float, margin: float) -> str:
    side = f"(greatest(geometry.xmax - geometry.xmin, geometry.ymax - geometry.ymin) + {2 * float(margin)}D)"
    return f"CAST(greatest(0, ceil(log2({side} / {SPAN * float(cell)}D))) AS INT)"


@dataclass(frozen=True)
class Survey:
    """Levels of both sides, their row counts, whether every geometry equals its envelope, and the most vertices of the others."""

    left: tuple[int, ...]
    right: tuple[int, ...]
    rows: tuple[int, int]
    boxes: tuple[bool, bool]
    vertices: tuple[int, int] = (0, 0)


def survey(left: DataFrame, right: DataFrame, cell: float, margin: float = 0.0) -> Survey:
    """One aggregate over the envelopes of both sides; a row per side and level reaches the driver."""

    def one(df, side, grown):
        size = "CASE WHEN geometry.boxy THEN 0 ELSE aggregate(geometry.parts, 0, (n, p) -> n + aggregate(p.rings, 0, (m, r) -> m + size(r))) END"
        return df.where("geometry.xmin IS NOT NULL").selectExpr(f"{side} AS side", f"{_own_level(cell, grown)} AS level", "geometry.boxy AS boxy", f"{size} AS v")

    both = one(left, 0, margin).unionAll(one(right, 1, 0.0)).groupBy("side", "level")
    both = both.agg(F.count("*").alias("n"), F.min("boxy").alias("boxy"), F.max("v").alias("v")).collect()
    sides = [[r for r in both if r.side == k] for k in (0, 1)]
    levels = [tuple(sorted(r.level for r in side)) for side in sides]
    most = tuple(max((r.v for r in side), default=0) for side in sides)
    return Survey(*levels, tuple(sum(r.n for r in side) for side in sides), tuple(all(r.boxy for r in side) for side in sides), most)


def list_cells(df: DataFrame, cell: float, margin: float = 0.0, names=("_cx", "_cy")) -> DataFrame:
    """One row per grid cell the envelope touches; the envelope is grown by `margin`."""

    def span(axis):
        low, high = f"floor((geometry.{axis}min - {margin}) / {cell})", f"floor((geometry.{axis}max + {margin}) / {cell})"
        return f"explode(sequence({low}, {high}))"

    cx, cy = names
    return df.where("geometry.xmin IS NOT NULL").selectExpr("*", f"{span('x')} AS {cx}").selectExpr("*", f"{span('y')} AS {cy}")


def _numbers(items) -> str:
    return f"CAST(array({', '.join(map(str, items))}) AS array<int>)"


def _code(df: DataFrame, cell: float, margin: float, mine: str | None) -> DataFrame:
    """One row per code in `_base`: twice the level, plus one where a pair meets on the right side's level."""
    there = df.where("geometry.xmin IS NOT NULL")
    if mine is None:
        return there.selectExpr("*", "0 AS _base")
    level = _own_level(cell, margin)
    return there.selectExpr("*", f"explode({mine.replace('_own_level', level)}) AS _base")


def _flat(seen: Survey, once: bool) -> bool:
    """Do all pairs meet on the lowest level."""
    return set(seen.left) <= {0} and (not once or set(seen.right) <= {0})


def _coded(left: DataFrame, right: DataFrame, cell: float, margin: float, seen: Survey, once: bool) -> tuple[DataFrame, DataFrame]:
    """Both sides under the levels where their pairs meet.

    Even codes: the left geometry is at its own level and the right one at that level or
    below.  Odd codes: the right geometry is at its own level and the left one below.  So
    two small geometries never meet in a large cell.
    """
    if _flat(seen, once):
        return _code(left, cell, margin, None), _code(right, cell, 0.0, None)
    if not once:
        return _code(left, cell, margin, "array(2 * _own_level)"), _code(right, cell, 0.0, _numbers([2 * k for k in seen.left]))
    lower = min(seen.left, default=0)
    above = f"transform(filter({_numbers(seen.right)}, k -> k > _own_level), k -> 2 * k + 1)"
    here = f"transform(filter({_numbers(seen.left)}, k -> k >= _own_level), k -> 2 * k)"
    own = f"CASE WHEN _own_level > {lower} THEN array(2 * _own_level + 1) ELSE {_numbers([])} END"
    return _code(left, cell, margin, f"concat(array(2 * _own_level), {above})"), _code(right, cell, 0.0, f"concat({here}, {own})")


def _list_codes(coded: DataFrame, cell: float, margin: float = 0.0) -> DataFrame:
    """One row per cell of the code's level that the envelope touches; `_level` counts halvings of the cell, negative for larger cells."""
    size = f"({cell} / power(2D, -(_base DIV 2)))"

    def span(axis):
        low, high = f"floor((geometry.{axis}min - {margin}) / {size})", f"floor((geometry.{axis}max + {margin}) / {size})"
        return f"explode(sequence({low}, {high}))"

    listed = coded.selectExpr("*", f"{span('x')} AS _cx").selectExpr("*", f"{span('y')} AS _cy")
    return listed.selectExpr("*", "CAST(-(_base DIV 2) AS INT) AS _level")


def _quarter_levels(left: DataFrame, right: DataFrame, cell: float, crowd: int) -> DataFrame:
    """Crowded base cells with the number of halvings that thins them out.

    Geometries are counted once per code, at their envelope centre, on the finest grid,
    and the counts are rolled up level by level.  A cell is not cut below the mean
    geometry size in it, which bounds the copies made.
    """
    g = F.col("geometry")
    fine = F.lit(cell) * F.pow(F.lit(2.0), F.floor(F.col("_base") / 2)) / 2**MAX_LEVEL

    def centres(df, nl, nr):
        return df.select(
            "_base",
            F.floor((g["xmin"] + g["xmax"]) / 2 / fine).alias("fx"),
            F.floor((g["ymin"] + g["ymax"]) / 2 / fine).alias("fy"),
            F.greatest(g["xmax"] - g["xmin"], g["ymax"] - g["ymin"]).alias("s"),
            F.lit(nl).alias("nl"),
            F.lit(nr).alias("nr"),
        )

    counts = centres(left, 1, 0).unionAll(centres(right, 0, 1)).groupBy("_base", "fx", "fy").agg(F.sum("nl").alias("nl"), F.sum("nr").alias("nr"), F.sum("s").alias("s"))
    base = 2**MAX_LEVEL
    at = ["_base", F.floor(F.col("fx") / base).alias("_cx"), F.floor(F.col("fy") / base).alias("_cy")]
    most = F.greatest(F.sum("nl"), F.sum("nr"))
    crowded = counts.groupBy(*at).agg(most.alias("total"), (F.sum("s") / F.sum(F.col("nl") + F.col("nr"))).alias("side")).where(F.col("total") > crowd)
    rolled = (
        counts.select("*", *at[1:])
        .join(crowded, ["_base", "_cx", "_cy"])
        .withColumn("_halve", F.explode(F.sequence(F.lit(1), F.lit(MAX_LEVEL))))
        .where(F.lit(cell) * F.pow(F.lit(2.0), F.floor(F.col("_base") / 2) - F.col("_halve")) >= F.col("side"))
        .withColumn("shift", F.pow(F.lit(2.0), F.lit(MAX_LEVEL) - F.col("_halve")))
        .groupBy("_base", "_cx", "_cy", "_halve", F.floor(F.col("fx") / F.col("shift")).alias("sx"), F.floor(F.col("fy") / F.col("shift")).alias("sy"))
        .agg(most.alias("n"))
        .groupBy("_base", "_cx", "_cy", "_halve")
        .agg(F.max("n").alias("n"))
    )
    return rolled.groupBy("_base", "_cx", "_cy").agg(
        F.coalesce(F.min(F.when(F.col("n") <= crowd, F.col("_halve"))), F.max("_halve")).alias("_halve")
    )


def _apply_levels(cells: DataFrame, levels: DataFrame | None, cell: float, margin: float) -> DataFrame:
    """Replace crowded base cells by their sub-cells."""
    if levels is None:
        return cells
    g = F.col("geometry")
    joined = cells.join(levels, ["_base", "_cx", "_cy"], "left").withColumn("_halve", F.coalesce("_halve", F.lit(0)))
    joined = joined.withColumn("_level", (F.col("_level") + F.col("_halve")).cast("int"))
    scale = F.pow(F.lit(2.0), F.col("_halve"))
    side = F.lit(cell) / F.pow(F.lit(2.0), F.col("_level"))

    def span(lo, hi, c):
        first = F.greatest(F.floor((lo - margin) / side), (F.col(c) * scale).cast("long"))
        last = F.least(F.floor((hi + margin) / side), ((F.col(c) + 1) * scale).cast("long") - 1)
        return F.sequence(first, last)

    return (
        joined.withColumn("_cx", F.explode(span(g["xmin"], g["xmax"], "_cx")))
        .withColumn("_cy", F.explode(span(g["ymin"], g["ymax"], "_cy")))
        .drop("_halve")
    )


def _slices(lcells: DataFrame, rcells: DataFrame, crowd: int) -> DataFrame:
    """Cells still crowded on either side, with slice counts."""
    loads = (
        lcells.selectExpr(*CELL_KEY, "1 AS nl", "0 AS nr")
        .unionAll(rcells.selectExpr(*CELL_KEY, "0 AS nl", "1 AS nr"))
        .groupBy(*CELL_KEY)
        .agg(F.sum("nl").alias("nl"), F.sum("nr").alias("nr"))
    )
    return loads.where((F.col("nl") > crowd) | (F.col("nr") > crowd)).select(
        *CELL_KEY,
        F.ceil(F.greatest(F.col("nl"), F.lit(1)) / crowd).cast("int").alias("_sl"),
        F.ceil(F.greatest(F.col("nr"), F.lit(1)) / crowd).cast("int").alias("_sr"),
    )


def _row_hash(cells: DataFrame) -> Column:
    skip = {*CELL_KEY, "_sl", "_sr"}
    flat = [F.col(c) for c, t in cells.dtypes if c not in skip and not t.startswith(("map", "struct", "array"))]
    g = F.col("geometry")
    return F.xxhash64(*flat, g["xmin"], g["ymin"], g["xmax"], g["ymax"])


def place(
    left: DataFrame, right: DataFrame, grid: Grid, margin: float = 0.0, once: bool = True, copies: bool = False, seen: Survey | None = None
) -> tuple[DataFrame, DataFrame, float, int]:
    """Both sides listed under join keys; returns (left, right, cell, slices), where slices is 0 or the most that a cell's right rows are cut into.

    With `copies`, equal right rows count once.  If no cell is crowded with them, they are dropped where a cell's
    rows have come together, which needs no shuffle of its own; else before anything is replicated.
    """
    if grid.cell is None:
        grid = replace(grid, cell=choose_cell(left, right, margin))
    cell, crowd = grid.cell, grid.crowd
    seen = seen or survey(left, right, cell, margin)
    bound, right = (right, right.dropDuplicates()) if copies else (None, right)
    lcoded, rcoded = _coded(left, right, cell, margin, seen, once)
    lcells, rcells = _list_codes(lcoded, cell, margin), _list_codes(rcoded, cell)
    plain = ["*", "0 AS _i", "0 AS _j"]

    def is_crowded(other: DataFrame) -> bool:
        # one narrow pass over envelopes decides between the plain and the crowded plan
        return not _slices(lcells, _list_codes(_coded(left, other, cell, margin, seen, once)[1], cell), crowd).isEmpty()

    levels = slices = None
    busy = bool(crowd) and max(seen.rows) > crowd
    if copies and crowd and not (busy and is_crowded(bound)):
        # columns that are the same everywhere are no join keys
        met = ["_cx", "_cy"] if _flat(seen, once) else CELL_KEY
        rcells = _list_codes(_coded(left, bound, cell, margin, seen, once)[1], cell).repartition(*met).dropDuplicates()
        return lcells.selectExpr(*plain), rcells.selectExpr(*plain), cell, 0
    if busy and is_crowded(right):
        if grid.quarter:
            levels = _quarter_levels(lcoded, rcoded, cell, crowd)
        lcells, rcells = _apply_levels(lcells, levels, cell, margin), _apply_levels(rcells, levels, cell, 0.0)
        slices = _slices(lcells, rcells, crowd)
    if slices is None:
        return lcells.selectExpr(*plain), rcells.selectExpr(*plain), cell, 0

    def cut(cells, own, count_own, other, count_other):
        joined = cells.join(slices, CELL_KEY, "left")
        joined = joined.withColumns({count_own: F.coalesce(count_own, F.lit(1)), count_other: F.coalesce(count_other, F.lit(1))})
        joined = joined.withColumn(own, F.pmod(_row_hash(cells), F.col(count_own)).cast("int"))
        return joined.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(count_other) - 1)))

    lcells = cut(lcells, "_j", "_sl", "_i", "_sr").drop("_sl")
    rcells = cut(rcells, "_i", "_sr", "_j", "_sl").drop("_sl", "_sr")
    return lcells, rcells, cell, slices.agg(F.max("_sr")).first()[0] or 1


def candidates(left: DataFrame, right: DataFrame, grid: Grid = Grid(), margin: float = 0.0, once: bool = True, **suffixes) -> DataFrame:
    """Pairs whose envelopes come within `margin`, with their cell key."""
    return plan_candidates(left, right, grid, margin, once, **suffixes)[0]


def plan_candidates(
    left: DataFrame,
    right: DataFrame,
    grid: Grid = Grid(),
    margin: float = 0.0,
    once: bool = True,
    lsuffix: str = "_left",
    rsuffix: str = "_right",
    copies: bool = False,
    seen: Survey | None = None,
    small: bool = False,
) -> tuple[DataFrame, int]:
    """Candidate pairs, and the most slices of a crowded cell, 0 where none is sliced.

    once=True emits each pair from one cell.  once=False emits it from every
    shared cell, for aggregates that add up or merge over cells; all cells of a left
    row then have one level.  copies=True lets equal right rows count once.  small=True
    broadcasts the cells of the right side.
    """
    lcells, rcells, cell, sliced = place(left, right, grid, margin, once, copies, seen)
    lnames, rnames = [c for c in lcells.columns if c not in KEY], [c for c in rcells.columns if c not in KEY]
    clash = set(lnames) & set(rnames)
    lcells = lcells.withColumnsRenamed({c: c + lsuffix for c in clash})
    rcells = rcells.withColumnsRenamed({c: c + rsuffix for c in clash})
    gl, gr, m = "geometry" + lsuffix, "geometry" + rsuffix, float(margin)
    pairs = lcells.join(F.broadcast(rcells) if small else unbroadcast(rcells), KEY).where(
        f"{gl}.xmin - {m} <= {gr}.xmax AND {gr}.xmin <= {gl}.xmax + {m} AND {gl}.ymin - {m} <= {gr}.ymax AND {gr}.ymin <= {gl}.ymax + {m}"
    )
    pairs = pairs.selectExpr("*", f"{cell} / power(2D, _level) AS _side", *([] if sliced else ["1 AS _sr"]))
    if once:
        pairs = pairs.where(
            f"_cx = floor(greatest({gl}.xmin - {m}, {gr}.xmin) / _side) AND _cy = floor(greatest({gl}.ymin - {m}, {gr}.ymin) / _side)"
        )
    return pairs, sliced


WORK = [*KEY, "_side", "_sr"]


def sjoin(
    left: DataFrame,
    right: DataFrame,
    distance: float = 0.0,
    grid: Grid = Grid(),
    lsuffix: str = "_left",
    rsuffix: str = "_right",
    boxes_only: bool | None = None,
    distance_col: str | None = None,
    small: bool = False,
    copies: bool = False,
) -> DataFrame:
    """Pairs that intersect (touching counts) or lie within `distance` (inclusive).

    When every geometry equals its envelope the whole test stays inside the
    JVM; boxes_only=None looks, True promises it.  small=True broadcasts the right side.
    copies=True lets equal right rows count once.
    """
    if grid.cell is None:
        grid = replace(grid, cell=choose_cell(left, right, distance))
    seen = survey(left, right, grid.cell, distance)
    if boxes_only is None:
        boxes_only = all(seen.boxes)
    pairs = candidates(left, right, grid, distance, True, lsuffix=lsuffix, rsuffix=rsuffix, seen=seen, small=small, copies=copies)
    gl, gr = F.col("geometry" + lsuffix), F.col("geometry" + rsuffix)
    if boxes_only:
        measured = pairs.withColumn("_gap", G.envelope_distance(gl, gr))
    elif distance == 0 and distance_col is None:
        # envelopes already meet; only pairs with a general shape need the kernel
        measured = pairs.withColumn("_gap", S.distance(gl, gr, 0.0))
    else:
        # far-apart pairs are dropped on envelopes before geometry travels to Python
        measured = pairs.where(G.envelope_distance(gl, gr) <= distance).withColumn("_gap", S.distance(gl, gr, distance))
    kept = measured.where(F.col("_gap") <= distance)
    if distance_col:
        kept = kept.withColumn(distance_col, F.col("_gap"))
    return kept.drop("_gap", *WORK)


def only_boxes(df: DataFrame) -> bool:
    """Does every geometry equal its envelope; stops at the first that does not."""
    return df.where(~F.col("geometry")["boxy"]).isEmpty()


def sjoin_keys(left: DataFrame, right: DataFrame, id_left: str, id_right: str, distance: float = 0.0, **kw) -> DataFrame:
    """Only the two keys of matching pairs."""
    return sjoin(left.select(id_left, "geometry"), right.select(id_right, "geometry"), distance, **kw).select(id_left, id_right)


def sjoin_envelopes(left: DataFrame, right: DataFrame, distance: float = 0.0, block: float = 5_000.0, grid: Grid = Grid(), **kw) -> DataFrame:
    """Prune whole blocks first, then join.

    Rows are blocked by the square their lower-left corner falls in; the
    envelopes of blocks (an aggregate, one row per block) are joined, and only
    rows of left blocks that meet some right block, and the reverse, go on.
    """

    def blocked(df):
        g = F.col("geometry")
        return df.withColumns({"_bx": F.floor(g["xmin"] / block), "_by": F.floor(g["ymin"] / block)})

    def envelopes(df):
        g = F.col("geometry")
        return df.groupBy("_bx", "_by").agg(
            F.min(g["xmin"]).alias("xmin"), F.min(g["ymin"]).alias("ymin"), F.max(g["xmax"]).alias("xmax"), F.max(g["ymax"]).alias("ymax")
        )

    def as_boxes(df):
        return df.withColumn("geometry", G.rectangle("xmin", "ymin", "xmax", "ymax")).select("_bx", "_by", "geometry")

    lb, rb = blocked(left), blocked(right)
    met = sjoin(as_boxes(envelopes(lb)), as_boxes(envelopes(rb)), distance, Grid(block, grid.crowd), boxes_only=True)
    keep_l = met.select(F.col("_bx_left").alias("_bx"), F.col("_by_left").alias("_by"))
    keep_r = met.select(F.col("_bx_right").alias("_bx"), F.col("_by_right").alias("_by"))
    lk = lb.join(keep_l.distinct(), ["_bx", "_by"], "left_semi").drop("_bx", "_by")
    rk = rb.join(keep_r.distinct(), ["_bx", "_by"], "left_semi").drop("_bx", "_by")
    return sjoin(lk, rk, distance, grid, **kw)


def sjoin_adaptive(left: DataFrame, right: DataFrame, distance: float = 0.0, cell: float | None = None, crowd: int = 2_000, **kw) -> DataFrame:
    """Cells cut into quarters until no cell holds more than `crowd` right rows."""
    return sjoin(left, right, distance, Grid(cell, crowd, True), **kw)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Is the table at most `rows` rows; reads no more than that many."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def sjoin_small(
    left: DataFrame,
    right: DataFrame,
    distance: float = 0.0,
    max_rows: int = 5_000,
    grid: Grid = Grid(),
    lsuffix: str = "_left",
    rsuffix: str = "_right",
    distance_col: str | None = None,
) -> DataFrame:
    """A right side checked to be small is broadcast under its grid cells, so the left side is not shuffled; else the grid join."""
    if not small_enough(right, max_rows):
        return sjoin(left, right, distance, grid, lsuffix, rsuffix, distance_col=distance_col)
    # rows that meet in a cell are not collected, so a crowded one needs no slices
    return sjoin(left, right, distance, replace(grid, crowd=None), lsuffix, rsuffix, distance_col=distance_col, small=True)


def sjoin_anti(left: DataFrame, right: DataFrame, keys: list[str], distance: float = 0.0, grid: Grid = Grid(), **kw) -> DataFrame:
    """Left rows with no right geometry within `distance`."""
    hit = sjoin(left.select(*keys, "geometry"), right.select("geometry"), distance, grid, **kw).select(*[F.col(k).alias(f"_hit{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_hit{i}"))
    return left.join(hit, same, "left_anti")


def contains(left: DataFrame, points: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Points strictly inside a polygon (points on its outline are not contained)."""
    gl, gr = F.col("geometry_left"), F.col("geometry_right")
    pairs = candidates(left, points, grid, 0.0, True)
    on_box = gl["boxy"]
    in_box = (gr["xmin"] > gl["xmin"]) & (gr["xmin"] < gl["xmax"]) & (gr["ymin"] > gl["ymin"]) & (gr["ymin"] < gl["ymax"])
    if only_boxes(left):
        return pairs.where(in_box).drop(*WORK)
    rim = S._distance(F.when(~on_box, G.boundary(gl)["parts"]), F.when(~on_box, gr["parts"]))
    inside = F.when(on_box, in_box).otherwise(G.point_in_polygon(gr["xmin"], gr["ymin"], gl) & (rim > 0))
    return pairs.where(inside).drop(*WORK)


def knn_within(
    left: DataFrame,
    right: DataFrame,
    id_left: str,
    id_right: str,
    k: int = 1,
    distance_threshold: float = 5_000,
    per: str = "pair",
    tie: str | None = None,
    grid: Grid = Grid(),
    **kw,
) -> DataFrame:
    """Nearest rows strictly within a threshold, distance rounded to whole metres.

    per="pair" ranks within (id_left, id_right), so k counts rows of each right
    class; per="left" ranks over all neighbours of a left row.
    """
    keep_r = [c for c in dict.fromkeys([id_right, *([tie] if tie else [])])]
    pairs = sjoin(left.select(id_left, "geometry"), right.select(*keep_r, "geometry"), distance_threshold, grid, distance_col="_near", **kw)
    pairs = pairs.where(F.col("_near") < distance_threshold)
    keys = [id_left, id_right] if per == "pair" else [id_left]
    order = [F.col("_near"), *( [F.col(tie)] if tie else []), F.col(id_right)]
    # the rank filter becomes a partial group limit before the shuffle, so a busy key ships k rows per task
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select(id_left, *keep_r, F.floor(F.col("_near") + 0.5).cast("int").alias("distance"), "rank")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage named by spark.checkpoint.dir."""
    spark = df.sparkSession
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if folder is None:
            import tempfile

            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="landgrain-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def adjacency(parcels: DataFrame, key: str = "id_parcel", distance: float = 0.0, ordered: bool = False, grid: Grid = Grid(), **kw) -> DataFrame:
    """Pairs of distinct rows of one layer that meet; ordered=True keeps each pair once."""
    side = parcels.select(key, "geometry")
    pairs = sjoin(side, side, distance, grid, **kw)
    a, b = F.col(key + "_left"), F.col(key + "_right")
    return pairs.where(a < b if ordered else a != b)


# -- J22: indexing a frame by grid ---------------------------------------------


def index_multi(df: DataFrame, size: int) -> DataFrame:
    """Every tile the geometry touches."""
    g = F.col("geometry")
    listed = list_cells(df, float(size), names=("_tx", "_ty"))
    general = S.distance(g, G.rectangle(F.col("_tx") * size, F.col("_ty") * size, (F.col("_tx") + 1) * size, (F.col("_ty") + 1) * size))
    return (
        listed.where(general <= 0)
        .withColumns({"tile_x": F.col("_tx") * size, "tile_y": F.col("_ty") * size})
        .drop("_tx", "_ty")
    )


def index_centroid(df: DataFrame, size: int) -> DataFrame:
    """The tile of the centroid."""
    c = G.centroid("geometry")
    x, y = G.grid_tile(c["x"], c["y"], size)
    return df.withColumns({"tile_x": x, "tile_y": y})


def index_chipped(df: DataFrame, size: int) -> DataFrame:
    """The geometry cut to each tile it touches; empty cuts are dropped."""
    g = F.col("geometry")
    listed = list_cells(df, float(size), names=("_tx", "_ty"))
    x0, y0 = F.col("_tx") * size, F.col("_ty") * size
    cut = S.clip_to_box(g, x0, y0, x0 + size, y0 + size)
    return (
        listed.withColumn("geometry", cut)
        .where(~G.is_empty("geometry"))
        .withColumns({"tile_x": x0, "tile_y": y0})
        .drop("_tx", "_ty")
    )
