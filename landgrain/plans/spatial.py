"""Spatial join, overlap and boundary queries over the fixture layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgrain.functions import geometry as G
from landgrain.functions import shapes as S
from landgrain.operators.nearest import knn_nearest
from landgrain.operators import linear, overlap, spatial_join as SJ, tables, tally
from landgrain.plans.book import query
from landgrain.plans.fixtures import CELL, SEGMENTS_SQL, layer, layer_sql, segments, spread, with_sql

MEET = "f.x0 <= p.x1 AND f.x1 >= p.x0 AND f.y0 <= p.y1 AND f.y1 >= p.y0"
SHARED = "greatest(least(p.x1, f.x1) - greatest(p.x0, f.x0), 0) * greatest(least(p.y1, f.y1) - greatest(p.y0, f.y0), 0)"
GAP = "sqrt(power(greatest(p.x0 - f.x1, f.x0 - p.x1, 0), 2) + power(greatest(p.y0 - f.y1, f.y0 - p.y1, 0), 2))"


def near(b) -> str:
    return f"f.x0 <= p.x1 + {b} AND f.x1 >= p.x0 - {b} AND f.y0 <= p.y1 + {b} AND f.y1 >= p.y0 - {b} AND {GAP} <= {b}"


def parcels(spark, sf):
    return layer(spark, sf, "parcels")


def features(spark, sf):
    return layer(spark, sf, "features")


# -- joins ---------------------------------------------------------------------


@query(
    "J1_intersects",
    with_sql("parcels", "features") + f"SELECT p.id_parcel, f.fid, f.class, f.k AS fk FROM parcels p JOIN features f ON {MEET}",
)
def j1(spark, sf):
    out = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), features(spark, sf).select("fid", "class", F.col("k").alias("fk"), "geometry"), grid=CELL)
    return out.select("id_parcel", "fid", "class", "fk")


@query(
    "J2_within_distance",
    with_sql("parcels", "hedges") + f"SELECT p.id_parcel, f.k AS hedge, round({GAP}, 6) AS distance FROM parcels p JOIN hedges f ON {near(25)}",
)
def j2(spark, sf):
    hedges = layer(spark, sf, "hedges").select(F.col("k").alias("hedge"), "geometry")
    out = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), hedges, 25, CELL, distance_col="distance")
    return out.select("id_parcel", "hedge", F.round("distance", 6).alias("distance"))


@query("J3_within_distance_keys", with_sql("parcels", "walls") + f"SELECT p.id_parcel, f.k AS wall FROM parcels p JOIN walls f ON {near(12)}")
def j3(spark, sf):
    walls = layer(spark, sf, "walls").withColumnRenamed("k", "wall")
    return SJ.sjoin_keys(parcels(spark, sf), walls, "id_parcel", "wall", 12, grid=CELL)


@query("J4_block_envelopes", with_sql("parcels", "water") + f"SELECT p.id_parcel, f.k AS water FROM parcels p JOIN water f ON {MEET}")
def j4(spark, sf):
    water = layer(spark, sf, "water").select(F.col("k").alias("water"), "geometry")
    return SJ.sjoin_envelopes(parcels(spark, sf).select("id_parcel", "geometry"), water, 0, 2_000.0, CELL).select("id_parcel", "water")


@query("J5_adaptive_cells", with_sql("parcels", "trees") + f"SELECT p.id_parcel, f.k AS tree FROM parcels p JOIN trees f ON {MEET}")
def j5(spark, sf):
    trees = layer(spark, sf, "trees").select(F.col("k").alias("tree"), "geometry")
    return SJ.sjoin_adaptive(parcels(spark, sf).select("id_parcel", "geometry"), trees, cell=1600.0, crowd=500).select("id_parcel", "tree")


@query(
    "J6_knn_per_class",
    with_sql("parcels", "walls")
    + f"""SELECT id_parcel, kind, wall, CAST(floor(d + 0.5) AS INT) AS distance, CAST(rank AS INT) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY id_parcel, kind ORDER BY d, wall) AS rank
        FROM (SELECT p.id_parcel, f.kind, f.k AS wall, {GAP} AS d FROM parcels p JOIN walls f ON {near(120)}) WHERE d < 120) WHERE rank <= 2""",
)
def j6(spark, sf):
    walls = layer(spark, sf, "walls").select("kind", F.col("k").alias("wall"), "geometry")
    return SJ.knn_within(parcels(spark, sf), walls, "id_parcel", "kind", 2, 120, "pair", "wall", CELL)


@query(
    "J6_knn_per_parcel",
    with_sql("parcels", "walls")
    + f"""SELECT id_parcel, wall, CAST(floor(d + 0.5) AS INT) AS distance, CAST(rank AS INT) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY id_parcel ORDER BY d, wall) AS rank
        FROM (SELECT p.id_parcel, f.k AS wall, {GAP} AS d FROM parcels p JOIN walls f ON {near(120)}) WHERE d < 120) WHERE rank <= 1""",
)
def j6_left(spark, sf):
    walls = layer(spark, sf, "walls").select(F.col("k").alias("wall"), "geometry")
    return SJ.knn_within(parcels(spark, sf), walls, "id_parcel", "wall", 1, 120, "left", None, CELL)


@query(
    "J7_knn_nearest",
    with_sql("hedges", "water")
    + f"""SELECT hedge, water, round(d, 6) AS distance, CAST(rank AS INT) AS rank FROM (
        SELECT p.k AS hedge, f.k AS water, {GAP} AS d, row_number() OVER (PARTITION BY p.k ORDER BY {GAP}, f.k) AS rank
        FROM hedges p, water f) WHERE rank <= 2""",
)
def j7(spark, sf):
    hedges = layer(spark, sf, "hedges").withColumnRenamed("k", "hedge")
    water = layer(spark, sf, "water").withColumnRenamed("k", "water")
    out = knn_nearest(hedges, water, "hedge", "water", 2)
    return out.select("hedge", "water", F.round("distance", 6).alias("distance"), "rank")


@query(
    "J8_adjacency",
    with_sql("parcels")
    + f"SELECT p.id_parcel AS id_parcel_left, f.id_parcel AS id_parcel_right FROM parcels p JOIN parcels f ON {near(4)} AND p.id_parcel != f.id_parcel",
)
def j8(spark, sf):
    return SJ.adjacency(parcels(spark, sf), distance=4, grid=CELL).select("id_parcel_left", "id_parcel_right")


@query(
    "J8_adjacency_ordered",
    with_sql("parcels")
    + f"SELECT p.id_parcel AS id_parcel_left, f.id_parcel AS id_parcel_right FROM parcels p JOIN parcels f ON {MEET} AND p.id_parcel < f.id_parcel",
)
def j8_ordered(spark, sf):
    return SJ.adjacency(parcels(spark, sf), ordered=True, grid=CELL).select("id_parcel_left", "id_parcel_right")


@query(
    "J9_spatial_anti",
    with_sql("trees", "parcels") + f"SELECT p.k AS tree, p.kind FROM trees p WHERE NOT EXISTS (SELECT 1 FROM parcels f WHERE {near(10)})",
)
def j9(spark, sf):
    trees = layer(spark, sf, "trees").select(F.col("k").alias("tree"), "kind", "geometry")
    return SJ.sjoin_anti(trees, parcels(spark, sf), ["tree"], 10, CELL).select("tree", "kind")


@query(
    "J10_contains",
    with_sql("parcels", "trees")
    + "SELECT p.id_parcel, f.k AS tree FROM parcels p JOIN trees f ON f.x0 > p.x0 AND f.x0 < p.x1 AND f.y0 > p.y0 AND f.y0 < p.y1",
)
def j10(spark, sf):
    trees = layer(spark, sf, "trees").select(F.col("k").alias("tree"), "geometry")
    return SJ.contains(parcels(spark, sf).select("id_parcel", "geometry"), trees, CELL).select("id_parcel", "tree")


@query(
    "J10_contains_diamond",
    with_sql("water", "trees") + "SELECT p.k AS water, f.k AS tree FROM water p JOIN trees f ON abs(f.x0 - p.x0) + abs(f.y0 - p.y0) < p.w",
)
def j10_diamond(spark, sf):
    trees = layer(spark, sf, "trees").select(F.col("k").alias("tree"), "geometry")
    zones = layer(spark, sf, "water").select(F.col("k").alias("water"), G.diamond("x0", "y0", "w").alias("geometry"))
    return SJ.contains(zones, trees, CELL).select("water", "tree")


@query(
    "J1_intersects_diamond",
    with_sql("water", "hedges")
    + """SELECT p.k AS water, f.k AS hedge FROM water p JOIN hedges f
         ON greatest(f.x0 - p.x0, p.x0 - f.x1, 0) + greatest(f.y0 - p.y0, p.y0 - f.y1, 0) <= p.w""",
)
def j1_diamond(spark, sf):
    hedges = layer(spark, sf, "hedges").select(F.col("k").alias("hedge"), "geometry")
    zones = layer(spark, sf, "water").select(F.col("k").alias("water"), G.diamond("x0", "y0", "w").alias("geometry"))
    return SJ.sjoin(zones, hedges, grid=CELL).select("water", "hedge")


TILES_SQL = "tiles AS (SELECT r * 5 + c AS tile, c * 20000 AS x0, r * 1000 AS y0, c * 20000 + 20000 AS x1, r * 1000 + 1000 AS y1 FROM range(5) t(c), (SELECT DISTINCT y0 // 1000 AS r FROM parcels))"


def tiles(spark, sf):
    """A tiling of 20 km by 1 km strips over the parcels' rows."""
    rows = parcels(spark, sf).select(F.floor(F.col("y0") / 1000).alias("r")).distinct()
    named = rows.select("r", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("c"))
    return named.select(
        (F.col("r") * 5 + F.col("c")).alias("tile"),
        G.rectangle(F.col("c") * 20000, F.col("r") * 1000, F.col("c") * 20000 + 20000, F.col("r") * 1000 + 1000).alias("geometry"),
    )


@query(
    "J11_small_side",
    with_sql("parcels") + f", {TILES_SQL} SELECT p.id_parcel, f.tile FROM parcels p JOIN tiles f ON {MEET}",
)
def j11(spark, sf):
    return SJ.sjoin_small(parcels(spark, sf).select("id_parcel", "geometry"), tiles(spark, sf), max_rows=5_000, grid=CELL).select("id_parcel", "tile")


@query(
    "J12_point_tile",
    with_sql("trees") + "SELECT k AS tree, ((x0 + 1) // 1000) * 1000 AS tile_x, ((y0 + 1) // 1000) * 1000 AS tile_y FROM trees",
)
def j12(spark, sf):
    trees = layer(spark, sf, "trees")
    tx, ty = G.grid_tile(F.col("x0") + 1, F.col("y0") + 1, 1000)
    return trees.select(F.col("k").alias("tree"), tx.alias("tile_x"), ty.alias("tile_y"))


@query(
    "J22_index_multi",
    with_sql("parcels")
    + """SELECT id_parcel, cx * 1000 AS tile_x, cy * 1000 AS tile_y FROM (
        SELECT *, unnest(range(x0 // 1000, x1 // 1000 + 1)) AS cx FROM parcels) q, LATERAL (SELECT unnest(range(q.y0 // 1000, q.y1 // 1000 + 1)) AS cy)""",
)
def j22_multi(spark, sf):
    return SJ.index_multi(parcels(spark, sf).select("id_parcel", "geometry"), 1000).select("id_parcel", "tile_x", "tile_y")


@query(
    "J22_index_centroid",
    with_sql("parcels")
    + "SELECT id_parcel, CAST(floor((x0 + x1) / 2.0 / 1000) * 1000 AS BIGINT) AS tile_x, CAST(floor((y0 + y1) / 2.0 / 1000) * 1000 AS BIGINT) AS tile_y FROM parcels",
)
def j22_centroid(spark, sf):
    return SJ.index_centroid(parcels(spark, sf), 1000).select("id_parcel", "tile_x", "tile_y")


@query(
    "J22_index_chipped",
    with_sql("parcels")
    + """SELECT id_parcel, tile_x, tile_y, round(w * h, 6) AS area FROM (
        SELECT id_parcel, cx * 1000 AS tile_x, cy * 1000 AS tile_y,
            CAST(least(q.x1, cx * 1000 + 1000) - greatest(q.x0, cx * 1000) AS DOUBLE) AS w,
            CAST(least(q.y1, cy * 1000 + 1000) - greatest(q.y0, cy * 1000) AS DOUBLE) AS h
        FROM (SELECT *, unnest(range(x0 // 1000, x1 // 1000 + 1)) AS cx FROM parcels) q, LATERAL (SELECT unnest(range(q.y0 // 1000, q.y1 // 1000 + 1)) AS cy))
        WHERE w > 0 AND h > 0""",
)
def j22_chipped(spark, sf):
    out = SJ.index_chipped(parcels(spark, sf).select("id_parcel", "geometry"), 1000)
    return out.select("id_parcel", "tile_x", "tile_y", F.round(G.area("geometry"), 6).alias("area"))


# -- areas -----------------------------------------------------------------------


def union_area_sql(pairs: str, keys: str) -> str:
    """CTEs that measure a union of rectangles (ax0, ay0, ax1, ay1) per key by strips."""
    return f"""pairs AS ({pairs}),
    cuts AS (SELECT DISTINCT {keys}, ax0 AS x FROM pairs UNION SELECT DISTINCT {keys}, ax1 FROM pairs),
    strips AS (SELECT *, lead(x) OVER (PARTITION BY {keys} ORDER BY x) AS nx FROM cuts),
    cover AS (SELECT {keys}, x, nx, ay0, ay1,
        max(ay1) OVER (PARTITION BY {keys}, x ORDER BY ay0, ay1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM strips JOIN pairs USING ({keys}) WHERE nx > x AND ax0 <= x AND ax1 >= nx),
    areas AS (SELECT {keys}, CAST(sum((nx - x) * greatest(ay1 - greatest(ay0, coalesce(top, ay0)), 0)) AS DOUBLE) AS area FROM cover GROUP BY ALL)"""


CUT = "greatest(p.x0, f.x0) AS ax0, greatest(p.y0, f.y0) AS ay0, least(p.x1, f.x1) AS ax1, least(p.y1, f.y1) AS ay1"
O2_SQL = (
    with_sql("parcels", "features")
    + ", "
    + union_area_sql(f"SELECT p.id_parcel, f.class, {CUT} FROM parcels p JOIN features f ON {MEET}", "id_parcel, class")
    + """, met AS (SELECT DISTINCT id_parcel, class FROM pairs),
    shares AS (SELECT id_parcel, class, least(greatest(coalesce(area, 0) / (w * h), 0), 1) AS proportion
        FROM met LEFT JOIN areas USING (id_parcel, class) JOIN parcels USING (id_parcel))
    """
)


def o2_frame(spark, sf):
    return overlap.parcel_proportion(parcels(spark, sf), features(spark, sf), ["class"], grid=CELL)


@query("O2_parcel_proportion", O2_SQL + "SELECT id_parcel, class, round(proportion, 9) AS proportion FROM shares")
def o2(spark, sf):
    return o2_frame(spark, sf).select("id_parcel", "class", F.round("proportion", 9).alias("proportion"))


@query(
    "O1_join_parcels",
    with_sql("parcels", "features")
    + ", "
    + union_area_sql(f"SELECT DISTINCT p.id_parcel, f.class, f.x0 AS ax0, f.y0 AS ay0, f.x1 AS ax1, f.y1 AS ay1 FROM parcels p JOIN features f ON {MEET}", "id_parcel, class")
    + "SELECT id_parcel, class, round(area, 6) AS union_area FROM areas",
)
def o1(spark, sf):
    out = overlap.join_parcels(parcels(spark, sf), features(spark, sf), ["class"], grid=CELL)
    return out.groupBy("id_parcel", "class").agg(F.round(F.sum(G.area("geometry_right")), 6).alias("union_area"))


@query(
    "O9_area_within_distances",
    with_sql("parcels", "water")
    + f"""SELECT id_parcel, kind, t AS distance_threshold, CAST(sum(a) AS DOUBLE) AS area, CAST(floor(min(d) + 0.5) AS INT) AS minimum_distance
        FROM (SELECT p.id_parcel, f.kind, f.w * f.h AS a, {GAP} AS d FROM parcels p JOIN water f ON {near(500)}), (VALUES (100), (200), (300), (500)) v(t)
        WHERE d <= t GROUP BY ALL""",
)
def o9(spark, sf):
    return overlap.area_within_distances(parcels(spark, sf), layer(spark, sf, "water"), ["kind"], [100, 200, 300, 500], grid=SJ.Grid(600.0))


def _buffer_sql():
    grown = "SELECT k, kind, {g} AS grp, {b} AS buf, x0 - {b} AS x0, y0 - {b} AS y0, x1 + {b} AS x1, y1 + {b} AS y1 FROM water{where}"
    groups = [("'all'", ""), ("'subset'", " WHERE kind = '0'"), ("'other'", " WHERE kind != '0'")]
    rows = " UNION ALL ".join(grown.format(g=g, b=b, where=w) for g, w in groups for b in (0, 6))
    cols = ", ".join(
        f"round(coalesce(max(CASE WHEN grp = {g} AND buf = {b} THEN least(coalesce(area, 0) / (w * h), 1) END), 0), 9) AS proportion_{g[1:-1]}_{b}m"
        for g, _ in groups
        for b in (0, 6)
    )
    return (
        with_sql("parcels", "water")
        + f", grown AS ({rows}), "
        + union_area_sql(f"SELECT p.id_parcel, f.grp, f.buf, {CUT} FROM parcels p JOIN grown f ON {MEET}", "id_parcel, grp, buf")
        + f", met AS (SELECT DISTINCT id_parcel, grp, buf FROM pairs) SELECT id_parcel, {cols} FROM met LEFT JOIN areas USING (id_parcel, grp, buf) JOIN parcels USING (id_parcel) GROUP BY id_parcel"
    )


@query("O10_buffered_proportion", _buffer_sql())
def o10(spark, sf):
    out = overlap.buffer_proportions(parcels(spark, sf), layer(spark, sf, "water"), [0, 6], F.col("kind") == "0", grow=overlap.mitred, grid=CELL)
    return out.select("id_parcel", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query("O14_area_within_round")
def o14_area(spark, sf):
    """Parcel area within 4 and 12 m of walls, rounded corners."""
    walls = layer(spark, sf, "walls")
    out = overlap.buffer_proportions(parcels(spark, sf), walls, [4, 12], grid=CELL)
    return out.select("id_parcel", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(
    "O11_any_and_each",
    with_sql("parcels", "features")
    + ", listed AS (SELECT class AS src, x0, y0, x1, y1 FROM features UNION ALL SELECT 'any', x0, y0, x1, y1 FROM features), "
    + union_area_sql(f"SELECT p.id_parcel, f.src, {CUT} FROM parcels p JOIN listed f ON {MEET}", "id_parcel, src")
    + ", met AS (SELECT DISTINCT id_parcel, src FROM pairs) SELECT id_parcel, "
    + ", ".join(f"round(coalesce(max(CASE WHEN src = '{s}' THEN area / (w * h) END), 0), 9) AS proportion_{s}" for s in ("any", "A", "N", "R"))
    + " FROM met LEFT JOIN areas USING (id_parcel, src) JOIN parcels USING (id_parcel) GROUP BY id_parcel",
)
def o11(spark, sf):
    out = overlap.any_and_each(parcels(spark, sf), features(spark, sf), "class", ["A", "N", "R"], grid=CELL)
    return out.select("id_parcel", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query(
    "O12_dominant_class",
    O2_SQL
    + """SELECT id_parcel, class, round(proportion, 9) AS proportion, coalesce(class IN ('A', 'R'), false) AS is_upland FROM (
        SELECT *, row_number() OVER (PARTITION BY id_parcel ORDER BY proportion DESC, class) AS rn FROM shares) WHERE rn = 1""",
)
def o12(spark, sf):
    out = overlap.dominant(o2_frame(spark, sf), "class")
    return out.select("id_parcel", "class", F.round("proportion", 9).alias("proportion"), F.coalesce(F.col("class").isin("A", "R"), F.lit(False)).alias("is_upland"))


@query(
    "O13_erase_by_tile",
    with_sql("parcels", "water")
    + """, chips AS (SELECT * FROM (SELECT q.id_parcel, cx * 1000 AS tile_x, cy * 1000 AS tile_y, greatest(q.x0, cx * 1000) AS x0, greatest(q.y0, cy * 1000) AS y0,
            least(q.x1, cx * 1000 + 1000) AS x1, least(q.y1, cy * 1000 + 1000) AS y1
        FROM (SELECT *, unnest(range(x0 // 1000, x1 // 1000 + 1)) AS cx FROM parcels) q, LATERAL (SELECT unnest(range(q.y0 // 1000, q.y1 // 1000 + 1)) AS cy)) WHERE x1 > x0 AND y1 > y0), """
    + union_area_sql(f"SELECT p.id_parcel, p.tile_x, p.tile_y, {CUT} FROM chips p JOIN water f ON {MEET}", "id_parcel, tile_x, tile_y")
    + """ SELECT id_parcel, tile_x, tile_y, (x1 - x0) * (y1 - y0) - coalesce(area, 0) AS area FROM chips LEFT JOIN areas USING (id_parcel, tile_x, tile_y)
        WHERE (x1 - x0) * (y1 - y0) - coalesce(area, 0) > 0""",
)
def o13(spark, sf):
    return overlap.erase_by_tile(parcels(spark, sf), layer(spark, sf, "water"), 1000, grid=CELL)


@query(
    "O19_pair_overlap",
    with_sql("parcels", "features") + f"SELECT p.id_parcel, f.fid, round(({SHARED}) / (p.w * p.h), 9) AS proportion FROM parcels p JOIN features f ON {MEET}",
)
def o19(spark, sf):
    out = overlap.overlap(parcels(spark, sf).select("id_parcel", "geometry"), features(spark, sf).select("fid", "geometry"), CELL)
    return out.select("id_parcel", "fid", F.round("proportion", 9).alias("proportion"))


# Diamonds are axis-parallel squares in the coordinates u = x + y and v = x - y, so pairs of them have a closed form.
DIAMONDS_SQL = """pairs AS (SELECT p.id_parcel, f.k AS water, p.w::DOUBLE AS r,
    least(p.x0 + p.y0 + p.w, f.x0 + f.y0 + f.w) - greatest(p.x0 + p.y0 - p.w, f.x0 + f.y0 - f.w) AS du,
    least(p.x0 - p.y0 + p.w, f.x0 - f.y0 + f.w) - greatest(p.x0 - p.y0 - p.w, f.x0 - f.y0 - f.w) AS dv
    FROM parcels p JOIN water f ON abs(f.x0 - p.x0) <= p.w + f.w + 100 AND abs(f.y0 - p.y0) <= p.w + f.w + 100)"""


def diamonds(spark, sf):
    plots = layer(spark, sf, "parcels").select("id_parcel", G.diamond("x0", "y0", "w").alias("geometry"))
    return plots, layer(spark, sf, "water").select(F.col("k").alias("water"), G.diamond("x0", "y0", "w").alias("geometry"))


@query("O19_pair_overlap_diamond", with_sql("parcels", "water") + f", {DIAMONDS_SQL} SELECT id_parcel, water, round(du * dv / 2 / (2 * r * r), 9) AS proportion FROM pairs WHERE du >= 0 AND dv >= 0")
def o19_diamond(spark, sf):
    plots, zones = diamonds(spark, sf)
    return overlap.overlap(plots, zones, CELL).select("id_parcel", "water", F.round("proportion", 9).alias("proportion"))


@query("J2_within_distance_diamond", with_sql("parcels", "water") + f", {DIAMONDS_SQL} SELECT id_parcel, water FROM pairs WHERE pow(greatest(-du, 0), 2) + pow(greatest(-dv, 0), 2) <= 2 * pow(49.9, 2)")
def j2_diamond(spark, sf):
    plots, zones = diamonds(spark, sf)
    return SJ.sjoin(plots, zones, 49.9, CELL).select("id_parcel", "water")


@query(
    "O20_overlap_census",
    with_sql("parcels")
    + f"""SELECT id_parcel, count(*) AS n_overlaps, CAST(sum(a) AS DOUBLE) AS overlap_area, round(sum(a / area), 6) AS proportion FROM (
        SELECT p.id_parcel, {SHARED} AS a, p.w * p.h AS area FROM parcels p JOIN parcels f ON {MEET} AND p.id_parcel != f.id_parcel) WHERE a > 0 GROUP BY 1""",
)
def o20(spark, sf):
    out = overlap.self_overlap(parcels(spark, sf), grid=CELL)
    return out.withColumn("proportion", F.round("proportion", 6))


@query(
    "O21_precision_recall",
    with_sql("parcels", "features")
    + f""", found AS (SELECT x0 // 10000 AS tile, x0, y0, x1, y1, w * h AS a FROM features), truth AS (SELECT x0 // 10000 AS tile, x0, y0, x1, y1, w * h AS a FROM parcels),
    sums AS (SELECT tile, sum(s) AS s, sum(a) AS fa, sum(b) AS tb FROM (
        SELECT p.tile, {SHARED} AS s, 0 AS a, 0 AS b FROM found p JOIN truth f ON p.tile = f.tile AND {MEET}
        UNION ALL SELECT tile, 0, a, 0 FROM found UNION ALL SELECT tile, 0, 0, a FROM truth) GROUP BY tile)
    SELECT tile, CAST(s AS DOUBLE) AS shared, CAST(fa AS DOUBLE) AS found, CAST(tb AS DOUBLE) AS truth, round(s / fa, 9) AS precision, round(s / tb, 9) AS recall,
        round(2 / (fa / s + tb / s), 9) AS f_score FROM sums""",
)
def o21(spark, sf):
    tile = F.floor(F.col("x0") / 10000).alias("tile")
    out = overlap.precision_recall(features(spark, sf).select(tile, "geometry"), parcels(spark, sf).select(tile, "geometry"), ["tile"], CELL)
    return out.select("tile", "shared", "found", "truth", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f_score")])


@query(
    "O24_length_in_areas",
    with_sql("parcels", "hedges")
    + f"""SELECT id_business, CAST(sum(greatest(least(p.x1, f.x1) - greatest(p.x0, f.x0), 0) + greatest(least(p.y1, f.y1) - greatest(p.y0, f.y0), 0)) AS DOUBLE) AS length,
        count(*) AS n FROM parcels p JOIN hedges f ON {MEET} GROUP BY 1""",
)
def o24(spark, sf):
    return overlap.length_inside(layer(spark, sf, "hedges"), parcels(spark, sf), ["id_business"], CELL)


@query(
    "O25_classes_hit",
    with_sql("parcels", "features") + f"SELECT p.id_parcel, string_agg(DISTINCT f.class, '-' ORDER BY f.class) AS classes FROM parcels p JOIN features f ON {MEET} GROUP BY 1",
)
def o25(spark, sf):
    out = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), features(spark, sf).select("class", "geometry"), grid=CELL)
    return out.groupBy("id_parcel").agg(tables.joined_set("class", "-").alias("classes"))


@query(
    "O26_dissolve",
    with_sql("parcels")
    + "SELECT id_business, count(*) AS n_parts, CAST(sum(w * h) AS DOUBLE) AS area, CAST(min(x0) AS DOUBLE) AS xmin, CAST(max(y1) AS DOUBLE) AS ymax, min(id_parcel) AS first_parcel FROM parcels GROUP BY 1",
)
def o26(spark, sf):
    out = parcels(spark, sf).groupBy("id_business").agg(F.min("id_parcel").alias("first_parcel"), G.collect_multipart("geometry").alias("geometry"))
    return out.select(
        "id_business", F.size("geometry.parts").cast("long").alias("n_parts"), G.area("geometry").alias("area"), "geometry.xmin", "geometry.ymax", "first_parcel"
    )


@query(
    "O27_clean_parcels",
    with_sql("parcels")
    + """SELECT id_business, count(*) AS n_parts, CAST(sum(w * h) AS DOUBLE) AS area FROM (
        SELECT id_business, w, h FROM parcels WHERE k % 5 != 0 UNION ALL SELECT id_business, w, h FROM parcels WHERE k % 5 = 0) WHERE w * h > 1500 GROUP BY 1""",
)
def o27(spark, sf):
    """Two sources, one with missing geometry, cleaned and dissolved per business."""
    p = parcels(spark, sf)
    keyed = p.where("k % 5 != 0").select("id_business", "geometry")
    unkeyed = p.where("k % 5 = 0").select("id_business", "geometry")
    both = keyed.unionByName(unkeyed).where(F.col("geometry").isNotNull())
    single = linear.dump_parts(both).where((G.dimension("geometry") == 2) & (G.area("geometry") > 50))
    merged = single.groupBy("id_business").agg(G.collect_multipart("geometry").alias("geometry"))
    cleaned = linear.dump_parts(merged.withColumn("geometry", S.clean("geometry"))).where(G.area("geometry") > 1500)
    out = cleaned.groupBy("id_business").agg(G.collect_multipart("geometry").alias("geometry"))
    return out.select("id_business", F.size("geometry.parts").cast("long").alias("n_parts"), G.area("geometry").alias("area"))


@query(
    "O28_three_layers",
    with_sql("parcels", "water", "walls")
    + ", band AS (SELECT x0 - 6 AS x0, y0 - 6 AS y0, x1 + 6 AS x1, y1 + 6 AS y1 FROM walls), "
    + union_area_sql(
        f"""SELECT id_parcel, greatest(p.ax0, f.x0) AS ax0, greatest(p.ay0, f.y0) AS ay0, least(p.ax1, f.x1) AS ax1, least(p.ay1, f.y1) AS ay1
            FROM (SELECT p.id_parcel, {CUT} FROM parcels p JOIN water f ON {MEET}) p JOIN band f ON f.x0 < p.ax1 AND f.x1 > p.ax0 AND f.y0 < p.ay1 AND f.y1 > p.ay0""",
        "id_parcel",
    )
    + " SELECT id_parcel, area FROM areas WHERE area > 0",
)
def o28(spark, sf):
    band = layer(spark, sf, "walls").withColumn("geometry", overlap.mitred("geometry", 6))
    out = overlap.shared_area(parcels(spark, sf), [layer(spark, sf, "water"), band], grid=CELL)
    return out.select("id_parcel", "area").where("area > 0")


@query(
    "O29_overlay_share",
    with_sql("parcels", "water")
    + f""", s AS (SELECT CAST(sum({SHARED}) AS DOUBLE) AS shared_area FROM parcels p JOIN water f ON {MEET}), t AS (SELECT CAST(sum(w * h) AS DOUBLE) AS total_area FROM water)
        SELECT shared_area, total_area, round(shared_area / total_area, 9) AS share FROM s, t""",
)
def o29(spark, sf):
    out = overlap.overlay_share(parcels(spark, sf), layer(spark, sf, "water"), CELL)
    return out.withColumn("share", F.round("share", 9))


@query(
    "O30_reverse_lookup",
    with_sql("parcels", "water") + f"SELECT f.k AS water, string_agg(DISTINCT p.id_parcel, ',' ORDER BY p.id_parcel) AS id_parcels FROM parcels p JOIN water f ON {MEET} GROUP BY 1",
)
def o30(spark, sf):
    water = layer(spark, sf, "water").select(F.col("k").alias("water"), "geometry")
    out = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), water, grid=CELL)
    return out.groupBy("water").agg(tables.joined_set("id_parcel").alias("id_parcels"))


@query(
    "O31_linear_linkage",
    with_sql("parcels", "hedges", "walls", "water")
    + f""", lines AS (SELECT 'hedge' AS source, kind AS class, x0, y0, x1, y1 FROM hedges WHERE kind != 'MACHINERY' UNION ALL SELECT 'wall', kind, x0, y0, x1, y1 FROM walls UNION ALL SELECT 'water', kind, x0, y0, x1, y1 FROM water)
        SELECT source, count(*) AS n_links, count(DISTINCT id_parcel) AS n_parcels, CAST(sum(n) AS BIGINT) AS n_parts FROM (
        SELECT f.source, p.id_parcel, f.class, count(*) AS n FROM parcels p JOIN lines f ON {near(12)} GROUP BY ALL) GROUP BY source""",
)
def o31(spark, sf):
    hedges, walls, water = (layer(spark, sf, n).select(F.col("kind").alias("class"), "geometry") for n in ("hedges", "walls", "water"))
    lines = tables.combine_long([hedges.where("class != 'MACHINERY'"), walls, water], ["hedge", "wall", "water"])
    links = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), lines, 12, CELL)
    merged = links.groupBy("source", "id_parcel", "class").agg(F.count("*").alias("n"))
    return merged.groupBy("source").agg(F.count("*").alias("n_links"), F.count_distinct("id_parcel").alias("n_parcels"), F.sum("n").alias("n_parts"))


@query(
    "O33_width_buffer",
    with_sql("parcels", "walls")
    + f"""SELECT p.id_parcel, f.k AS wall FROM parcels p JOIN (SELECT *, CASE WHEN k % 3 = 0 THEN NULL ELSE k % 10 END AS width FROM walls) f
        ON f.x0 <= p.x1 + 9 AND f.x1 >= p.x0 - 9 AND f.y0 <= p.y1 + 9 AND f.y1 >= p.y0 - 9 AND {GAP} <= coalesce(f.width, 0)""",
)
def o33(spark, sf):
    width = F.when(F.col("k") % 3 != 0, F.col("k") % 10)
    walls = layer(spark, sf, "walls").select(F.col("k").alias("wall"), width.alias("width"), "geometry")
    out = SJ.sjoin(parcels(spark, sf).select("id_parcel", "geometry"), walls, 9, CELL, distance_col="d")
    return out.where(F.col("d") <= F.coalesce("width", F.lit(0))).select("id_parcel", "wall")


# -- boundaries -------------------------------------------------------------------


def spans_sql(name: str, source: str, buffers, extra: str = "", where: str = "", line: bool = True) -> str:
    """CTE with the merged length of each segment within each buffer of axis-parallel features."""
    keys = f"id_boundary, b{extra and ', ' + extra}"
    pick = extra and f"f.{extra}, "
    zero = " AND b > 0" if line else ""
    vals = ", ".join(f"({b})" for b in buffers)
    far = max(buffers)
    return f"""{name}_hits AS (
        SELECT s.id_boundary, {pick}b, CASE WHEN s.sx0 = s.sx1 THEN 'v' ELSE 'h' END AS o, least(s.sx0, s.sx1) AS ax0, greatest(s.sx0, s.sx1) AS ax1, least(s.sy0, s.sy1) AS ay0, greatest(s.sy0, s.sy1) AS ay1,
            f.x0 AS fx0, f.x1 AS fx1, f.y0 AS fy0, f.y1 AS fy1,
            greatest(f.x0 - greatest(s.sx0, s.sx1), least(s.sx0, s.sx1) - f.x1, 0) AS gx, greatest(f.y0 - greatest(s.sy0, s.sy1), least(s.sy0, s.sy1) - f.y1, 0) AS gy
        FROM segments s JOIN {source} f ON f.x0 <= greatest(s.sx0, s.sx1) + {far} AND f.x1 >= least(s.sx0, s.sx1) - {far}
            AND f.y0 <= greatest(s.sy0, s.sy1) + {far} AND f.y1 >= least(s.sy0, s.sy1) - {far}{where}, (VALUES {vals}) v(b) WHERE true{zero}),
    {name}_spans AS (
        SELECT {keys}, CASE WHEN o = 'h' THEN greatest(ax0, fx0 - sqrt(b * b - gy * gy)) ELSE greatest(ay0, fy0 - sqrt(b * b - gx * gx)) END AS t0,
            CASE WHEN o = 'h' THEN least(ax1, fx1 + sqrt(b * b - gy * gy)) ELSE least(ay1, fy1 + sqrt(b * b - gx * gx)) END AS t1
        FROM {name}_hits WHERE (o = 'h' AND gy <= b) OR (o = 'v' AND gx <= b)),
    {name}_runs AS (
        SELECT *, max(t1) OVER (PARTITION BY {keys} ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM {name}_spans WHERE t1 > t0),
    {name} AS (SELECT {keys}, sum(greatest(t1 - greatest(t0, coalesce(top, t0)), 0)) AS len FROM {name}_runs GROUP BY ALL)"""


BUFFERS = linear.BUFFERS


def _share_cols(buffers, digits=6):
    return ", ".join(f"round(least(coalesce(max(CASE WHEN b = {b} THEN len END), 0) / m, 1), {digits}) AS proportion_{b}m" for b in buffers)


def _o3_sql(source, buffers, line):
    return (
        with_sql("parcels", source)
        + f", {SEGMENTS_SQL}, "
        + spans_sql("cov", source, buffers, line=line)
        + f", met AS (SELECT DISTINCT p.id_parcel FROM parcels p JOIN {source} f ON {near(max(buffers))})"
        + f" SELECT id_boundary, id_parcel, m, {_share_cols(buffers)} FROM segments JOIN met USING (id_parcel) LEFT JOIN cov USING (id_boundary) GROUP BY id_boundary, id_parcel, m"
    )


def _o3(spark, sf, source):
    out = linear.boundary_proportion(segments(spark, sf), layer(spark, sf, source), [], BUFFERS, parcels(spark, sf), grid=CELL)
    return out.select("id_boundary", "id_parcel", "m", *[F.round(f"proportion_{b}m", 6).alias(f"proportion_{b}m") for b in BUFFERS])


@query("O3_boundary_hedges", _o3_sql("hedges", BUFFERS, True))
def o3_hedges(spark, sf):
    return _o3(spark, sf, "hedges")


@query("O3_boundary_water", _o3_sql("water", BUFFERS, False))
def o3_water(spark, sf):
    return _o3(spark, sf, "water")


@query(
    "O3_boundary_adjacency",
    with_sql("parcels")
    + f", {SEGMENTS_SQL}, others AS (SELECT id_parcel AS id_parcel_right, x0, y0, x1, y1 FROM parcels), "
    + spans_sql("cov", "others", [2, 12], "id_parcel_right", " AND s.id_parcel != f.id_parcel_right", False)
    + f""", met AS (SELECT p.id_parcel, f.id_parcel_right FROM parcels p JOIN others f ON {near(12)} AND p.id_parcel != f.id_parcel_right)
        SELECT id_boundary, id_parcel, m, id_parcel_right, {_share_cols([2, 12])} FROM segments JOIN met USING (id_parcel) LEFT JOIN cov USING (id_boundary, id_parcel_right) GROUP BY id_boundary, id_parcel, m, id_parcel_right""",
)
def o3_adjacency(spark, sf):
    out = linear.boundary_adjacency(parcels(spark, sf), segments(spark, sf), [2, 12], grid=CELL)
    return out.select("id_boundary", "id_parcel", "m", "id_parcel_right", *[F.round(f"proportion_{b}m", 6).alias(f"proportion_{b}m") for b in (2, 12)])


def _flags_sql(threshold):
    """Segment flags for adjacency and four uses at 12 m."""
    ctes = [spans_sql("adj", "others", [12], "id_parcel_right", " AND s.id_parcel != f.id_parcel_right", False)]
    for use, source, line in (("hedgerow", "hedges", True), ("relict", "relicts", True), ("wall", "walls", True), ("water", "water", False)):
        ctes.append(spans_sql(f"u_{use}", source, [12], line=line))
    flag = "coalesce((SELECT {t} < max(len / m) FROM {n} WHERE {n}.id_boundary = s.id_boundary), false) AS {c}"
    flags = ", ".join(flag.format(t=threshold, n=n, c=c) for n, c in (("adj", "f_adj"), ("u_hedgerow", "f_hedgerow"), ("u_relict", "f_relict"), ("u_wall", "f_wall"), ("u_water", "f_water")))
    return (
        with_sql("parcels", "hedges", "walls", "water")
        + f", {SEGMENTS_SQL}, others AS (SELECT id_parcel AS id_parcel_right, x0, y0, x1, y1 FROM parcels), relicts AS (SELECT * FROM hedges WHERE kind = 'BUILDING'), "
        + ", ".join(ctes)
        + f", flags AS (SELECT s.*, {flags} FROM segments s)"
    )


def _o7_sql(threshold=0.5):
    uses = ["hedgerow", "relict", "wall", "water"]
    both = {u: f"f_{u}" for u in uses}
    both |= {"wall_or_hedgerow": "(f_hedgerow OR f_wall)", "wall_or_hedgerow_or_water": "(f_hedgerow OR f_wall OR f_water)"}
    half = "(CASE WHEN f_adj THEN m / 2 ELSE m END)"
    cols = ["CAST(sum(m) AS DOUBLE) AS m"] + [f"sum(CASE WHEN {f} THEN m ELSE 0 END) AS m_{u}" for u, f in both.items()]
    cols += [f"sum({half}) AS m_adj"] + [f"sum(CASE WHEN {f} THEN {half} ELSE 0 END) AS m_adj_{u}" for u, f in both.items()]
    rest = f"sum({half}) - " + " - ".join(f"sum(CASE WHEN f_{u} THEN {half} ELSE 0 END)" for u in uses)
    return _flags_sql(threshold) + f" SELECT id_parcel, {', '.join(cols)}, {rest} AS m_adj_none FROM flags GROUP BY 1"


USE_NAMES = ["hedgerow", "relict", "wall", "water"]


def boundary_tables(spark, sf, uses=("hedgerow", "relict", "wall", "water")):
    """Segments, their adjacency, and the share of each near every use, all uses in one pass."""
    p, s = parcels(spark, sf), segments(spark, sf)
    hedges = layer(spark, sf, "hedges")
    sources = {"hedgerow": hedges, "relict": hedges.where("kind = 'BUILDING'"), "wall": layer(spark, sf, "walls"), "water": layer(spark, sf, "water")}
    feats = tables.combine_long([sources[u].select("geometry") for u in uses], list(uses)).withColumnRenamed("source", "use")
    adj = linear.boundary_proportion(s, p.select(F.col("id_parcel").alias("id_parcel_right"), "geometry"), ["id_parcel_right"], [12], grid=CELL, exclude=("id_parcel", "id_parcel_right"))
    return s, adj, linear.boundary_proportion(s, feats, ["use"], [12], grid=CELL)


@query("O7_boundary_merger", _o7_sql(0.5))
def o7(spark, sf):
    s, adj, near_uses = boundary_tables(spark, sf)
    return linear.merge_boundaries(s, adj, linear.use_flags(near_uses, USE_NAMES), USE_NAMES)


@query("O7_boundary_merger_90p12m", _o7_sql(0.9))
def o7_90(spark, sf):
    s, adj, near_uses = boundary_tables(spark, sf)
    flags = linear.use_flags(near_uses, USE_NAMES, "0.9 < proportion_12m")
    return linear.merge_boundaries(s, adj, flags, USE_NAMES, "0.9 < proportion_12m")


SEG_GAP = "sqrt(power(greatest(least(s.sx0, s.sx1) - f.x0, f.x0 - greatest(s.sx0, s.sx1), 0), 2) + power(greatest(least(s.sy0, s.sy1) - f.y0, f.y0 - greatest(s.sy0, s.sy1), 0), 2))"
SEG_NEAR = "f.x0 <= greatest(s.sx0, s.sx1) + 24 AND f.x0 >= least(s.sx0, s.sx1) - 24 AND f.y0 <= greatest(s.sy0, s.sy1) + 24 AND f.y0 >= least(s.sy0, s.sy1) - 24"
COUNT_BUFFERS = [2, 4, 8, 12, 24]
O4_CTES = (
    f", {SEGMENTS_SQL}, hits AS (SELECT s.id_boundary, s.id_parcel, s.m, f.k AS fid, {SEG_GAP} AS d FROM segments s JOIN trees f ON {SEG_NEAR} AND {SEG_GAP} <= 24), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY id_parcel, fid ORDER BY d, id_boundary) AS rn FROM hits), "
    "counts AS (SELECT id_boundary, id_parcel, m, "
    + ", ".join(f"CAST(sum(CASE WHEN rn = 1 AND d <= {b} THEN 1 ELSE 0 END) AS INT) AS count_{b}m" for b in COUNT_BUFFERS)
    + " FROM ranked GROUP BY ALL), rim AS (SELECT id_parcel, fid, min(d) AS d FROM hits GROUP BY ALL), "
    "inner_trees AS (SELECT p.id_parcel, f.k AS fid FROM parcels p JOIN trees f ON f.x0 BETWEEN p.x0 AND p.x1 AND f.y0 BETWEEN p.y0 AND p.y1), "
    "interior AS (SELECT id_parcel, "
    + ", ".join(f"CAST(sum(CASE WHEN coalesce(d, 1e9) >= {b} THEN 1 ELSE 0 END) AS INT) AS count_{b}m" for b in [0, *COUNT_BUFFERS])
    + " FROM inner_trees LEFT JOIN rim USING (id_parcel, fid) GROUP BY 1)"
)


def trees(spark, sf):
    return layer(spark, sf, "trees").withColumnRenamed("k", "fid")


@query("O4_nearest_boundary_counts", with_sql("parcels", "trees") + O4_CTES + " SELECT * FROM counts")
def o4(spark, sf):
    return tally.nearest_segment_counts(segments(spark, sf), trees(spark, sf), "fid", COUNT_BUFFERS, grid=CELL)


@query("O5_interior_counts", with_sql("parcels", "trees") + O4_CTES + " SELECT * FROM interior")
def o5(spark, sf):
    return tally.interior_counts(parcels(spark, sf), segments(spark, sf), trees(spark, sf), "fid", [0, *COUNT_BUFFERS], grid=CELL)


def _o8_sql():
    half = "CASE WHEN f_adj THEN 0.5 ELSE 1 END"
    cols = []
    for b in (4, 8):
        cols.append(f"CAST(sum(count_{b}m) AS INT) AS n_boundary_trees_{b}m")
        cols.append(f"sum(CASE WHEN has_adj THEN count_{b}m * ({half}) END) AS n_adj_boundary_trees_{b}m")
        for u in ("hedgerow", "water"):
            cols.append(f"CAST(sum(CASE WHEN f_{u} THEN count_{b}m ELSE 0 END) AS INT) AS n_{u}_trees_{b}m")
            cols.append(f"sum(CASE WHEN has_adj AND f_{u} THEN count_{b}m * ({half}) ELSE 0 END) AS n_adj_{u}_trees_{b}m")
    base = _flags_sql(0.5)
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    outer = ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
    inner = ", ".join(f"coalesce(i.count_{b}m, 0) AS n_interior_trees_{b}m" for b in (4, 8))
    total = ", ".join(f"coalesce(n_adj_boundary_trees_{b}m, 0) + coalesce(i.count_{b}m, 0) AS n_adj_trees_{b}m" for b in (4, 8))
    return (
        base.replace(f"water AS {layer_sql('water')} ", f"water AS {layer_sql('water')}, trees AS {layer_sql('trees')} ", 1)
        + O4_CTES.replace(f", {SEGMENTS_SQL}", "", 1)
        + f""", known AS (SELECT DISTINCT id_boundary FROM adj), tallied AS (SELECT c.*, f.f_adj, f.f_hedgerow, f.f_water, k.id_boundary IS NOT NULL AS has_adj
            FROM counts c JOIN flags f USING (id_boundary) LEFT JOIN known k USING (id_boundary)),
        summed AS (SELECT id_parcel, {', '.join(cols)} FROM tallied GROUP BY 1)
        SELECT id_parcel, {outer}, {inner}, {total} FROM summed FULL JOIN interior i USING (id_parcel)"""
    )


@query("O8_parcel_tree_features", _o8_sql())
def o8(spark, sf):
    s, adj, near_uses = boundary_tables(spark, sf, ("hedgerow", "water"))
    flags = linear.use_flags(near_uses, ["hedgerow", "water"])
    counts = tally.nearest_segment_counts(s, trees(spark, sf), "fid", COUNT_BUFFERS, grid=CELL)
    inner = tally.interior_counts(parcels(spark, sf), s, trees(spark, sf), "fid", [0, *COUNT_BUFFERS], grid=CELL)
    out = tally.parcel_tree_features(counts, adj, flags, ["hedgerow", "water"], inner)
    doubles = [c for c, t in out.dtypes if t == "double"]
    return out.withColumns({c: F.round(c, 6) for c in doubles})


@query(
    "O6_segmentise",
    with_sql("parcels")
    + """, sides AS (SELECT id_parcel, k, CASE WHEN n % 2 = 0 THEN h ELSE w END AS m FROM parcels, (VALUES (0), (1), (2), (3)) t(n))
        SELECT id_parcel, CAST(sum(ceil(m / 50.0)) AS BIGINT) AS n, CAST(sum(m) AS DOUBLE) AS m FROM sides GROUP BY 1""",
)
def o6(spark, sf):
    out = linear.segmentise_boundary(spread(parcels(spark, sf)))
    return out.groupBy("id_parcel").agg(F.count("*").alias("n"), F.round(F.sum("m"), 6).alias("m"))


def use_spans(spark, sf, buffer=12):
    s = segments(spark, sf)
    named = {"hedgerow": "hedges", "wall": "walls", "water": "water"}
    feats = None
    for use, source in named.items():
        one = layer(spark, sf, source).select(F.lit(use).alias("use"), "geometry")
        feats = one if feats is None else feats.unionAll(one)
    return s, linear.buffer_spans(s, feats, ["use"], [buffer], grid=CELL)


USES = ["hedgerow", "wall", "water"]


def _o15_ctes():
    feats = " UNION ALL ".join(f"SELECT '{u}' AS use, x0, y0, x1, y1 FROM {n}" for u, n in (("hedgerow", "hedges"), ("wall", "walls"), ("water", "water")))
    return (
        with_sql("parcels", "hedges", "walls", "water")
        + f", {SEGMENTS_SQL}, feats AS ({feats}), "
        + spans_sql("cov", "feats", [12], "use")
        + """, ends AS (SELECT DISTINCT id_boundary, t FROM (SELECT id_boundary, t0 AS t FROM cov_spans WHERE t1 > t0 UNION ALL SELECT id_boundary, t1 FROM cov_spans WHERE t1 > t0
            UNION ALL SELECT id_boundary, CASE WHEN sx0 = sx1 THEN least(sy0, sy1) ELSE least(sx0, sx1) END FROM segments
            UNION ALL SELECT id_boundary, CASE WHEN sx0 = sx1 THEN greatest(sy0, sy1) ELSE greatest(sx0, sx1) END FROM segments)),
        cells AS (SELECT id_boundary, t AS a, lead(t) OVER (PARTITION BY id_boundary ORDER BY t) AS b FROM ends),
        flagged AS (SELECT c.id_boundary, c.a, c.b, """
        + ", ".join(f"coalesce(bool_or(s.use = '{u}' AND s.t0 <= c.a AND s.t1 >= c.b), false) AS bool_{u}" for u in USES)
        + " FROM cells c LEFT JOIN cov_spans s ON s.id_boundary = c.id_boundary WHERE c.b > c.a GROUP BY ALL)"
    )


@query(
    "O15_divide_by_use",
    _o15_ctes() + f" SELECT id_boundary, {', '.join('bool_' + u for u in USES)}, round(sum(b - a), 4) AS m FROM flagged GROUP BY ALL HAVING round(sum(b - a), 4) > 0",
)
def o15(spark, sf):
    s, spans = use_spans(spark, sf)
    pieces = linear.divide_by_use(spans, USES, s)
    out = pieces.groupBy("id_boundary", *[f"bool_{u}" for u in USES]).agg(F.sum("m").alias("m"))
    return out.withColumn("m", F.round("m", 4)).where("m > 0")


@query(
    "O16_allocate_by_priority",
    _o15_ctes()
    + """ SELECT id_boundary, use, round(sum(len), 4) AS m FROM (SELECT id_boundary, b - a AS len, CASE WHEN bool_water THEN 'water' WHEN bool_hedgerow THEN 'hedgerow' WHEN bool_wall THEN 'wall' ELSE 'none' END AS use FROM flagged)
        GROUP BY ALL HAVING round(sum(len), 4) > 0""",
)
def o16(spark, sf):
    s, spans = use_spans(spark, sf)
    pieces = linear.allocate_by_priority(linear.divide_by_use(spans, USES, s), ["water", "hedgerow", "wall"])
    return pieces.groupBy("id_boundary", "use").agg(F.round(F.sum("m"), 4).alias("m")).where("m > 0")


@query(
    "O17_relict_classes",
    with_sql("parcels", "hedges")
    + f", {SEGMENTS_SQL}, "
    + spans_sql("cov", "hedges", [4])
    + " SELECT id_boundary, m, round(coalesce(max(len), 0), 6) AS m_woody, m > 2 AND coalesce(max(len), 0) / m > 0.3 AS is_relict FROM segments LEFT JOIN cov USING (id_boundary) GROUP BY id_boundary, m",
)
def o17(spark, sf):
    s = segments(spark, sf)
    spans = linear.buffer_spans(s, layer(spark, sf, "hedges"), [], [4], grid=CELL)
    woody = spans.groupBy("id_boundary").agg(F.sum((F.col("t1") - F.col("t0")) * F.col("run")).alias("m_woody"))
    lengths = s.select("id_boundary", "m").join(SJ.unbroadcast(woody), "id_boundary", "left").na.fill(0.0, ["m_woody"])
    return linear.classify_relict(lengths).withColumn("m_woody", F.round("m_woody", 6))


def _o18_sql():
    cov = spans_sql("cov", "others", [2, 8], "", " AND s.id_boundary != f.ok")
    cols = ", ".join(
        f"round(least(coalesce(max(CASE WHEN b = {b} THEN len END), 0) / m, 1), 6) AS proportion_{b}m, CASE WHEN least(coalesce(max(CASE WHEN b = {b} THEN len END), 0) / m, 1) > 0.95 THEN m / 2 ELSE m END AS m_counted_{b}m"
        for b in (2, 8)
    )
    return (
        with_sql("hedges", "walls")
        + ", lines AS (SELECT k, x0, y0, x1, y1, w + h AS m FROM hedges UNION ALL SELECT 1000000000 + k, x0, y0, x1, y1, w + h FROM walls),"
        + " segments AS (SELECT k AS id_boundary, x0 AS sx0, y0 AS sy0, x1 AS sx1, y1 AS sy1, CAST(m AS DOUBLE) AS m FROM lines), others AS (SELECT k AS ok, x0, y0, x1, y1 FROM lines), "
        + cov
        + f" SELECT id_boundary AS line, m, {cols} FROM segments LEFT JOIN cov USING (id_boundary) GROUP BY id_boundary, m"
    )


@query("O18_single_sided", _o18_sql())
def o18(spark, sf):
    hedges = layer(spark, sf, "hedges").select(F.col("k").alias("line"), "geometry")
    walls = layer(spark, sf, "walls").select((F.lit(1000000000) + F.col("k")).alias("line"), "geometry")
    lines = hedges.unionAll(walls)
    out = linear.single_sided(lines, lines.withColumnRenamed("line", "other"), [2, 8], "line", ("line", "other"), CELL)
    return out.withColumns({f"proportion_{b}m": F.round(f"proportion_{b}m", 6) for b in (2, 8)})


@query(
    "O14_length_within",
    with_sql("parcels", "water")
    + f", {SEGMENTS_SQL}, "
    + spans_sql("cov", "water", [4, 8, 12], line=False)
    + " SELECT id_parcel, " + ", ".join(f"round(coalesce(sum(CASE WHEN b = {b} THEN len END), 0), 6) AS m_boundary_{b}m" for b in (4, 8, 12))
    + " FROM segments JOIN cov USING (id_boundary) GROUP BY 1",
)
def o14_length(spark, sf):
    s = segments(spark, sf)
    spans = linear.buffer_spans(s, layer(spark, sf, "water"), [], [4, 8, 12], grid=CELL)
    run = (F.col("t1") - F.col("t0")) * F.col("run")
    out = spans.join(SJ.unbroadcast(s.select("id_boundary", "id_parcel")), "id_boundary").groupBy("id_parcel")
    return out.agg(*[F.round(F.coalesce(F.sum(F.when(F.col("buffer") == float(b), run)), F.lit(0.0)), 6).alias(f"m_boundary_{b}m") for b in (4, 8, 12)])


@query(
    "O32_buffer_metrics",
    with_sql("parcels", "hedges", "water")
    + f"""SELECT id_parcel, {', '.join(f"CAST(coalesce(sum(CASE WHEN src = 'hedge' AND d <= {b} THEN len / 2.0 END), 0) AS DOUBLE) AS m_hedge_{b}m, round(coalesce(sum(CASE WHEN src = 'water' AND d <= {b} THEN a / 10000.0 END), 0), 9) AS ha_water_{b}m" for b in (0, 4, 8, 12))}
        FROM (SELECT p.id_parcel, NULL AS src, 0 AS len, 0 AS a, NULL AS d FROM parcels p
            UNION ALL SELECT p.id_parcel, 'hedge', f.w + f.h, 0, {GAP} FROM parcels p JOIN hedges f ON {near(12)}
            UNION ALL SELECT p.id_parcel, 'water', 0, f.w * f.h, {GAP} FROM parcels p JOIN water f ON {near(12)}) GROUP BY 1""",
)
def o32(spark, sf):
    p = parcels(spark, sf).select("id_parcel", "geometry")
    frames = []
    for src, name in (("hedge", "hedges"), ("water", "water")):
        one = layer(spark, sf, name).select(G.length("geometry").alias("len"), G.area("geometry").alias("a"), "geometry")
        frames.append(SJ.sjoin(p, one, 12, CELL, distance_col="d").select("id_parcel", F.lit(src).alias("src"), "len", "a", "d"))
    rows = frames[0].unionAll(frames[1])
    aggs = []
    for b in (0, 4, 8, 12):
        on = F.col("d") <= b
        aggs.append(F.sum(F.when((F.col("src") == "hedge") & on, F.col("len") / 2)).alias(f"m_hedge_{b}m"))
        aggs.append(F.round(F.sum(F.when((F.col("src") == "water") & on, F.col("a") / 10000)), 9).alias(f"ha_water_{b}m"))
    wide = rows.groupBy("id_parcel").agg(*aggs)
    return p.select("id_parcel").join(wide, "id_parcel", "left").na.fill(0.0)


@query(
    "O34_inner_and_outer_edges",
    with_sql("parcels", "water")
    + f"""SELECT id_parcel, CAST(sum(m) AS DOUBLE) AS m, CAST(sum(inner_m) AS DOUBLE) AS m_internal FROM (
        SELECT id_parcel, 2 * (w + h) AS m, 0 AS inner_m FROM parcels
        UNION ALL SELECT id_parcel, len, len FROM (SELECT p.id_parcel, unnest([
            CASE WHEN f.x0 BETWEEN p.x0 AND p.x1 THEN greatest(least(p.y1, f.y1) - greatest(p.y0, f.y0), 0) ELSE 0 END,
            CASE WHEN f.x1 BETWEEN p.x0 AND p.x1 THEN greatest(least(p.y1, f.y1) - greatest(p.y0, f.y0), 0) ELSE 0 END,
            CASE WHEN f.y0 BETWEEN p.y0 AND p.y1 THEN greatest(least(p.x1, f.x1) - greatest(p.x0, f.x0), 0) ELSE 0 END,
            CASE WHEN f.y1 BETWEEN p.y0 AND p.y1 THEN greatest(least(p.x1, f.x1) - greatest(p.x0, f.x0), 0) ELSE 0 END]) AS len
            FROM parcels p JOIN water f ON {MEET})) GROUP BY 1""",
)
def o34(spark, sf):
    """Outline length plus the length of land-cover edges inside each parcel."""
    p = parcels(spark, sf).select("id_parcel", "geometry")
    edges = linear.dump_edges(layer(spark, sf, "water").select("k", "geometry")).select(G.segment("x0", "y0", "x1", "y1").alias("geometry"))
    inner = overlap.length_inside(edges, p, ["id_parcel"], CELL).select("id_parcel", F.col("length").alias("inner_m"))
    out = p.select("id_parcel", G.length("geometry").alias("outer_m")).join(inner, "id_parcel", "left").na.fill(0.0)
    return out.select("id_parcel", (F.col("outer_m") + F.col("inner_m")).alias("m"), F.col("inner_m").alias("m_internal"))


def tree_pairs(spark, sf):
    s = segments(spark, sf).select("id_boundary", "id_parcel", "geometry")
    t = trees(spark, sf).select("fid", "kind", "geometry")
    return SJ.sjoin(s, t, 12, CELL, distance_col="distance").select("id_boundary", "id_parcel", "fid", "kind", "distance")


TREE_PAIRS_SQL = (
    with_sql("parcels", "trees")
    + f", {SEGMENTS_SQL}, near12 AS (SELECT s.id_boundary, s.id_parcel, f.k AS fid, f.kind, {SEG_GAP} AS d FROM segments s JOIN trees f ON {SEG_NEAR} AND {SEG_GAP} <= 12)"
)


def _o22_sql(once):
    rows = "(SELECT id_parcel, fid, min(d) AS d, any_value(kind) AS kind FROM near12 GROUP BY id_parcel, fid)" if once else "near12"
    cols = ", ".join(
        [f"CAST(sum(CASE WHEN d <= {b} THEN 1 ELSE 0 END) AS BIGINT) AS trees_{b}m" for b in (2, 4, 8, 12)]
        + [f"CAST(sum(CASE WHEN d <= {b} AND kind = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks_{b}m" for b in (2, 4, 8, 12)]
    )
    return TREE_PAIRS_SQL + f" SELECT id_parcel, {cols} FROM {rows} GROUP BY 1"


METRICS = {"trees": "CAST(1 AS BIGINT)", "clicks": "CAST(kind = 'click' AS BIGINT)"}


@query("O22_metric_product", _o22_sql(True))
def o22(spark, sf):
    return tally.metric_product(tree_pairs(spark, sf), "id_parcel", "fid", METRICS, [2, 4, 8, 12])


@query("O22_metric_product_double", _o22_sql(False))
def o22_double(spark, sf):
    return tally.metric_product(tree_pairs(spark, sf), "id_parcel", "fid", METRICS, [2, 4, 8, 12], once_per_parcel=False)


@query(
    "O23_count_report",
    TREE_PAIRS_SQL
    + " SELECT CAST(b AS DOUBLE) AS buffer, count(DISTINCT fid) AS n_features, count(*) AS n_matches, count(DISTINCT id_parcel) AS n_parcels FROM near12, (VALUES (2), (4), (8), (12)) v(b) WHERE d <= b GROUP BY 1",
)
def o23(spark, sf):
    return tally.count_report(tree_pairs(spark, sf), "id_parcel", "fid", [2, 4, 8, 12])
