"""Nearest neighbours without a radius, by descent through two count pyramids.

Every row has a point of its geometry and a leaf cell that holds the point; cells
grow by a factor of four from level to level.  A geometry larger than a leaf rests in
a cell of its own size, apart from the smaller ones, so one large shape does not widen
the box of a small cell.  A node of the pyramid keeps the number of its rows, the box
of their points and the box of their envelopes.

A pair of nodes gives two bounds: no two of their geometries are nearer than the
envelope boxes, and every two are at most as far apart as the corners of the point
boxes.  The smallest far bound that covers k right rows limits the k-th distance of
all rows of a left node, and right nodes beyond it are dropped.  Both pyramids are
descended together from the root, one checkpointed job per level, so an isolated row
costs a few nodes per level and never meets the right side as a whole.  The last step
takes single left rows for nodes, and what they still meet is dealt out by its count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from landgrain.functions import geometry as G
from landgrain.functions import shapes as S
from landgrain.operators.spatial_join import durable

LEAF_ROWS = 16
"""Right rows of a leaf on average; cells get smaller while one of them has CROWD rows."""
CROWD = 64
REFINEMENTS = 8
MET_ROWS = 250_000
"""Pairs of rows of a task on average."""
SLACK = 1 + 1e-9
"""Far bounds are widened by this factor, so rounding drops no pair."""

NODE = ["_c", "_x", "_y"]


def _placed(df: DataFrame, id_col: str) -> DataFrame:
    """(id, geometry, a point of it); null and empty geometries have no neighbours."""
    p = F.get(F.get(F.get("geometry.parts", F.lit(0))["rings"], F.lit(0)), F.lit(0))
    placed = df.select(F.col(id_col).alias("_id"), "geometry", p["x"].alias("_px"), p["y"].alias("_py"))
    return placed.where("_px IS NOT NULL AND _py IS NOT NULL")


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of rows with one geometry only the k smallest ids can be among k neighbours."""
    ranked = rows.withColumn("_n", F.row_number().over(W.partitionBy("geometry").orderBy("_id")))
    return ranked.where(F.col("_n") <= k).drop("_n")


def _in_leaves(rows: DataFrame, x0: float, y0: float, leaf: float, top: int) -> DataFrame:
    g = F.col("geometry")
    size = F.greatest(g["xmax"] - g["xmin"], g["ymax"] - g["ymin"]) / leaf
    level = F.when(size > 1, F.least(F.ceil(F.log(4.0, size)), F.lit(top))).otherwise(0).cast("int")

    def number(p: str, origin: float) -> Column:
        return F.floor((F.col(p) - origin) / leaf).cast("long")

    rows = rows.withColumn("_c", level)
    return rows.withColumns({"_x": _up(number("_px", x0), F.col("_c")), "_y": _up(number("_py", y0), F.col("_c"))})


def _up(number: Column, levels: Column) -> Column:
    """The number of the cell `levels` levels up; numbers are not negative."""
    return F.call_function("shiftright", number, levels * 2)


def _leaf_nodes(rows: DataFrame) -> DataFrame:
    g = F.col("geometry")
    return rows.groupBy(*NODE).agg(
        F.count("*").alias("n"),
        *[F.min(c).alias(n) for c, n in ((g["xmin"], "ex0"), (g["ymin"], "ey0"), ("_px", "px0"), ("_py", "py0"))],
        *[F.max(c).alias(n) for c, n in ((g["xmax"], "ex1"), (g["ymax"], "ey1"), ("_px", "px1"), ("_py", "py1"))],
    )


def _nodes(leaves: DataFrame, level: int, side: str) -> DataFrame:
    """Nodes of one level with the cell of their parent; a node rests below the level of its own size."""
    rise = F.greatest(F.lit(level) - F.col("_c"), F.lit(0))
    raised = leaves.withColumns({"_x": _up(F.col("_x"), rise), "_y": _up(F.col("_y"), rise)})
    merged = raised.groupBy(*NODE).agg(
        F.sum("n").alias("n"),
        *[F.min(c).alias(c) for c in ("ex0", "ey0", "px0", "py0")],
        *[F.max(c).alias(c) for c in ("ex1", "ey1", "px1", "py1")],
    )
    step = (F.col("_c") <= level).cast("int")
    parents = merged.withColumns({"_ux": _up(F.col("_x"), step), "_uy": _up(F.col("_y"), step)})
    return parents.select([F.col(c).alias(side + c) for c in parents.columns])


def _bounded(pairs: DataFrame, k: int, key=("l__c", "l__x", "l__y"), keep=()) -> DataFrame:
    """Pairs of nodes that can hold one of the k nearest rows, with the bound of the left node, which `key` names."""

    def gap(axis: str) -> Column:
        a, b = f"l_e{axis}", f"r_e{axis}"
        return F.greatest(F.col(a + "0") - F.col(b + "1"), F.col(b + "0") - F.col(a + "1"), F.lit(0.0))

    def reach(axis: str) -> Column:
        a, b = f"l_p{axis}", f"r_p{axis}"
        return F.greatest(F.col(a + "1") - F.col(b + "0"), F.col(b + "1") - F.col(a + "0"))

    own = W.partitionBy(*key)
    near, far = F.hypot(gap("x"), gap("y")), F.hypot(reach("x"), reach("y")) * SLACK
    pairs = pairs.select(*key, *["r_" + c for c in NODE], *keep, F.col("r_n"), near.alias("_near"), far.alias("_far"))
    pairs = pairs.withColumn("_sum", F.sum("r_n").over(own.orderBy("_far").rowsBetween(W.unboundedPreceding, W.currentRow)))
    bound = F.coalesce(F.min(F.when(F.col("_sum") >= k, F.col("_far"))).over(own), F.lit(float("inf")))
    return pairs.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound")).drop("_near", "_far", "_sum", *({"r_n"} - set(keep)))


def _descend(left: DataFrame, right: DataFrame, top: int, k: int) -> DataFrame:
    """Pairs of leaves (l__c, l__x, l__y, r__c, r__x, r__y, _bound)."""
    cells = ["c", "x", "y"]
    a, b = _nodes(left, top, "l_"), _nodes(right, top, "r_")
    pairs = _bounded(a.join(b, (F.col("l__ux") == F.col("r__ux")) & (F.col("l__uy") == F.col("r__uy"))), k)
    for level in range(top - 1, -1, -1):
        up = pairs.select(*[F.col(f"{s}__{c}").alias(f"{s}_u{c}") for s in "lr" for c in cells])
        a, b = _nodes(left, level, "l_"), _nodes(right, level, "r_")
        up = up.join(a, (F.col("l_uc") == F.col("l__c")) & (F.col("l_ux") == F.col("l__ux")) & (F.col("l_uy") == F.col("l__uy")))
        up = up.join(b, (F.col("r_uc") == F.col("r__c")) & (F.col("r_ux") == F.col("r__ux")) & (F.col("r_uy") == F.col("r__uy")))
        pairs = durable(_bounded(up, k))
    return pairs


def _rows_in_nodes(leaves: DataFrame, rows: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Left rows with the right leaves that can hold one of their k nearest: (l__row, l_ex0 to l_py1, r__c, r__x, r__y, r_n, _bound)."""
    g = F.col("geometry")
    sides = {"l_ex0": g["xmin"], "l_ey0": g["ymin"], "l_ex1": g["xmax"], "l_ey1": g["ymax"]}
    spots = {f"l_p{c}{n}": F.col("_p" + c) for c in "xy" for n in (0, 1)}
    one = rows.select(F.col("_row").alias("l__row"), *[F.col(c).alias("l_" + c) for c in NODE], *[e.alias(c) for c, e in (sides | spots).items()])
    b = nodes.select([F.col(c).alias("r_" + c) for c in nodes.columns])
    met = leaves.drop("_bound").join(one, ["l_" + c for c in NODE]).join(b, ["r_" + c for c in NODE])
    return _bounded(met, k, ["l__row"], [*sides, *spots, "r_n"])


def knn_nearest(left: DataFrame, right: DataFrame, id_left: str, id_right: str, k: int = 1) -> DataFrame:
    """The k nearest right rows of every left row: (id_left, id_right, distance, rank).

    Equal distances rank by id_right.  A left row gets fewer rows only if the right side
    has fewer; rows with a null or empty geometry take no part.
    """
    lf = durable(_placed(left, id_left).withColumn("_row", F.monotonically_increasing_id()))
    rt = durable(_first_copies(_placed(right, id_right), k).withColumn("_row", F.monotonically_increasing_id()))
    both = lf.select("_px", "_py", F.lit(0).alias("_r")).unionAll(rt.select("_px", "_py", F.lit(1).alias("_r")))
    seen = both.agg(F.min("_px").alias("x0"), F.min("_py").alias("y0"), F.max("_px").alias("x1"), F.max("_py").alias("y1"), F.sum("_r").alias("n")).first()
    x0, y0 = seen.x0 or 0.0, seen.y0 or 0.0
    wide = max((seen.x1 or 0.0) - x0, (seen.y1 or 0.0) - y0) or 1.0
    top = max(0, math.ceil(math.log(max(seen.n or 0, 1) / LEAF_ROWS, 16))) if (seen.n or 0) > LEAF_ROWS else 0
    for _ in range(REFINEMENTS):
        leaf = wide / 4**top * SLACK
        held = _in_leaves(rt, x0, y0, leaf, top).groupBy(*NODE).count().agg(F.max("count")).first()[0] or 0
        if held < CROWD:
            break
        top += 1
    leaf = wide / 4**top * SLACK
    lf, rt = _in_leaves(lf, x0, y0, leaf, top), _in_leaves(rt, x0, y0, leaf, top)
    nodes = durable(_leaf_nodes(rt))
    rows = durable(_rows_in_nodes(_descend(durable(_leaf_nodes(lf)), nodes, top, k), lf, nodes, k))
    held = rows.agg(F.sum("r_n")).first()[0] or 0
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-held // MET_ROWS))

    # on envelopes and points alone: the k-th far bound of each left row leaves a few pairs for the exact distance
    b = rt.select(F.col("_row").alias("r__row"), "_px", "_py", *[F.col(f"geometry.{c}").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], *[F.col(c).alias("r_" + c) for c in NODE])
    met = rows.repartition(tasks).join(b, ["r_" + c for c in NODE])

    def gap(axis: str) -> Column:
        return F.greatest(F.col(f"l_e{axis}0") - F.col(f"{axis}max"), F.col(f"{axis}min") - F.col(f"l_e{axis}1"), F.lit(0.0))

    met = met.select("l__row", "r__row", "_bound", F.hypot(gap("x"), gap("y")).alias("_near"), (F.hypot(F.col("l_px0") - F.col("_px"), F.col("l_py0") - F.col("_py")) * SLACK).alias("_far"))
    own = W.partitionBy("l__row").orderBy("_far")
    met = met.where(F.col("_near") <= F.col("_bound")).repartition(tasks, "l__row").withColumn("_nth", F.row_number().over(own))
    bound = F.coalesce(F.min(F.when(F.col("_nth") == k, F.col("_far"))).over(W.partitionBy("l__row")), F.lit(float("inf")))
    few = met.withColumn("_bound", bound).where(F.col("_near") <= F.col("_bound")).select("l__row", "r__row")

    a = lf.select(F.col("_row").alias("l__row"), F.col("_id").alias("_a"), F.col("geometry").alias("_ga"))
    b = rt.select(F.col("_row").alias("r__row"), F.col("_id").alias("_b"), F.col("geometry").alias("_gb"))
    exact = few.join(b, "r__row").join(a, "l__row").select("_a", "_b", S.distance("_ga", "_gb").alias("distance"))
    ranked = exact.withColumn("rank", F.row_number().over(W.partitionBy("_a").orderBy("distance", "_b"))).where(F.col("rank") <= k)
    return ranked.select(F.col("_a").alias(id_left), F.col("_b").alias(id_right), "distance", "rank")
