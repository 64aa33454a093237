"""Raster-table queries and rule pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.functions import shapes as S
from landgrain.functions import text as X
from landgrain.operators import habitats as H
from landgrain.operators import linear, overlap, ranking, raster as R, spatial_join as SJ, tables as T, tally
from landgrain.plans.book import query
from landgrain.plans.fixtures import CELL, SEGMENTS_SQL, layer, segments, table, with_sql
from landgrain.plans.rows import ARABLE, FARMS_SQL, GRASSLAND, ARABLE_SQL, GRASS_SQL, SCENES, farms
from landgrain.plans.spatial import CUT, GAP, MEET, SHARED, USES, _o15_ctes, near, o2_frame, O2_SQL, parcels, union_area_sql, use_spans

# -- R: rasters as tables -------------------------------------------------------------

RES = 40
PIXELS = (
    "SELECT idx, scene_rank, concat('scene_', CAST(scene_rank AS varchar(20))) AS scene, idx % 1000 AS col, idx // 1000 AS row, CAST((event_id * 31) % 97 * 50 AS DOUBLE) AS red,"
    " CAST((event_id * 57) % 89 * 60 AS DOUBLE) AS nir, CAST((event_id * 13) % 101 AS DOUBLE) AS cloud, CAST((event_id * 17) % 83 * 40 AS DOUBLE) AS green,"
    " CAST((event_id * 23) % 71 * 45 AS DOUBLE) AS swir, value FROM (SELECT *, event_id // 4 AS idx, event_id % 4 AS scene_rank FROM events)"
)
PIX = f"WITH pixels AS ({PIXELS}) "


def pixels(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("events")
    return spark.sql(PIXELS.replace("//", "DIV").replace("varchar(20)", "string"))


def mean_grid(spark, sf):
    """One value per cell: the mean of the event values there."""
    return pixels(spark, sf).groupBy("col", "row").agg(F.round(F.avg("value"), 6).alias("value"))


GRID_SQL = "grid AS (SELECT col, row, round(avg(value), 6) AS value FROM pixels GROUP BY ALL)"


@query("R1_normalised_difference", PIX + "SELECT idx, scene, round((nir - red) / nullif(nir + red, 0), 9) AS ndvi FROM pixels")
def r1(spark, sf):
    return pixels(spark, sf).select("idx", "scene", F.round(R.normalised_difference("nir", "red"), 9).alias("ndvi"))


@query("R2_offset", PIX + "SELECT idx, scene, greatest(red - 1000, 0) AS red, nir FROM pixels")
def r2(spark, sf):
    return pixels(spark, sf).select("idx", "scene", R.apply_offset("red", -1000).alias("red"), R.apply_offset("nir", 0).alias("nir"))


@query("R3_mask_and_trim", PIX + "SELECT idx, scene, nullif(red, 0) AS red, CASE WHEN nir < 4000 THEN nir / 10000 END AS nir, cloud / 100 AS cloud FROM pixels")
def r3(spark, sf):
    return pixels(spark, sf).select("idx", "scene", R.mask_value("red", 0).alias("red"), (R.trim("nir", 4000) / 10000).alias("nir"), (F.col("cloud") / 100).alias("cloud"))


@query("R4_resample", PIX + ", coarse AS (SELECT col // 3 AS c, row // 3 AS r, max(cloud) AS cloud20 FROM pixels GROUP BY ALL) SELECT idx, scene, cloud20 FROM pixels JOIN coarse ON c = col // 3 AND r = row // 3")
def r4(spark, sf):
    p = pixels(spark, sf)
    coarse = p.groupBy(F.floor(F.col("col") / 3).alias("col"), F.floor(F.col("row") / 3).alias("row")).agg(F.max("cloud").alias("cloud20"))
    return R.resample_nearest(p, coarse, 3, "cloud20").select("idx", "scene", "cloud20")


NDVI = "(CASE WHEN nir < 10000 THEN nullif(nir, 0) END - CASE WHEN red < 10000 THEN nullif(red, 0) END) / nullif(CASE WHEN nir < 10000 THEN nullif(nir, 0) END + CASE WHEN red < 10000 THEN nullif(red, 0) END, 0)"


def stacked(spark, sf):
    """Bands as rows, then back as columns."""
    long = T.pivot_long(pixels(spark, sf).select("scene", "scene_rank", "col", "row", "red", "nir", "cloud", "green", "swir"), ["red", "nir", "cloud", "green", "swir"], "band", "value")
    return R.band_columns(long, ["red", "nir", "cloud", "green", "swir"])


@query("R5_ndvi_cloud", PIX + f"SELECT col, row, scene, round({NDVI}, 9) AS ndvi, CASE WHEN red != 0 THEN cloud / 100 END AS cloud FROM pixels")
def r5(spark, sf):
    out = R.ndvi_cloud(stacked(spark, sf), "red", "nir", "cloud")
    return out.select("col", "row", "scene", F.round("ndvi", 9).alias("ndvi"), "cloud")


@query("R6_ndvi_ndsi", PIX + "SELECT col, row, scene, round((nullif(nir, 0) - nullif(red, 0)) / (nir + red), 9) AS ndvi, round((nullif(swir, 0) - nullif(green, 0)) / (swir + green), 9) AS ndsi FROM pixels")
def r6(spark, sf):
    out = R.ndvi_ndsi(stacked(spark, sf), "red", "nir", "green", "swir")
    return out.select("col", "row", "scene", F.round("ndvi", 9).alias("ndvi"), F.round("ndsi", 9).alias("ndsi"))


@query(
    "R7_clearest_composite",
    PIX + f"""SELECT col, row, scene, round(CASE WHEN coalesce(cloud <= 0.2, true) THEN ndvi END, 9) AS ndvi, cloud FROM (
        SELECT *, row_number() OVER (PARTITION BY col, row ORDER BY cloud ASC NULLS LAST, CASE WHEN cloud IS NULL THEN -scene_rank ELSE scene_rank END) AS rn FROM (
        SELECT col, row, scene, scene_rank, {NDVI} AS ndvi, CASE WHEN red != 0 THEN cloud / 100 END AS cloud FROM pixels)) WHERE rn = 1""",
)
def r7(spark, sf):
    best = R.clearest_pixels(R.ndvi_cloud(pixels(spark, sf), "red", "nir", "cloud"), ["ndvi"])
    return best.select("col", "row", "scene", F.round("ndvi", 9).alias("ndvi"), "cloud")


@query(
    "R8_snow_free_composite",
    # The scenes of a pixel in order, each replaced by the next while it has to be.
    "WITH RECURSIVE" + PIX.removeprefix("WITH") + """, lit AS (
        SELECT col, row, scene, row_number() OVER (PARTITION BY col, row ORDER BY scene_rank) AS step, (nullif(nir, 0) - nullif(red, 0)) / (nir + red) AS ndvi, (nullif(swir, 0) - nullif(green, 0)) / (swir + green) AS ndsi FROM pixels),
        held AS (SELECT * FROM lit WHERE step = 1
            UNION ALL SELECT n.col, n.row, CASE WHEN swap THEN n.scene ELSE h.scene END, n.step, CASE WHEN swap THEN n.ndvi ELSE h.ndvi END, CASE WHEN swap THEN n.ndsi ELSE h.ndsi END
            FROM (SELECT *, coalesce(ndsi < 0.32, false) OR ndvi IS NULL AS swap FROM held) h JOIN lit n ON n.col = h.col AND n.row = h.row AND n.step = h.step + 1)
        SELECT col, row, scene, round(ndvi, 9) AS ndvi FROM held QUALIFY row_number() OVER (PARTITION BY col, row ORDER BY step DESC) = 1""",
)
def r8(spark, sf):
    best = R.snow_free_pixels(R.ndvi_ndsi(pixels(spark, sf), "red", "nir", "green", "swir"), ["ndvi"])
    return best.select("col", "row", "scene", F.round("ndvi", 9).alias("ndvi"))


@query("R9_cloud_cover", PIX + "SELECT scene, round(avg(CASE WHEN m = 1 THEN 1.0 ELSE 0 END), 9)::DOUBLE AS share_cloud, round(avg(CASE WHEN m > 0 AND m < 1 THEN 1.0 ELSE 0 END), 9)::DOUBLE AS share_uncertain FROM (SELECT scene, CASE WHEN cloud > 80 THEN 1 WHEN cloud < 30 THEN 0 ELSE 0.5 END AS m FROM pixels) GROUP BY 1")
def r9(spark, sf):
    m = F.when(F.col("cloud") > 80, 1.0).when(F.col("cloud") < 30, 0.0).otherwise(0.5)
    out = pixels(spark, sf).withColumn("mask", m).groupBy("scene").agg(*R.cloud_cover())
    return out.select("scene", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query("R10_raster_summary", PIX + "SELECT scene, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(var_pop(v), 4) AS variance, round(stddev_pop(v), 6) AS std, round(count(*) FILTER (v IS NULL) / count(*), 9) AS null_share FROM (SELECT scene, nullif(red, 0) AS v FROM pixels) GROUP BY 1")
def r10(spark, sf):
    out = R.summary(pixels(spark, sf).select("scene", R.mask_value("red", 0).alias("value")), ["scene"])
    digits = {"variance": 4, "null_share": 9, "mean": 6, "median": 6, "std": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "R11_fill_nearest",
    PIX + f""", {GRID_SQL}, holey AS (SELECT col, row, CASE WHEN (col + row) % 7 = 3 THEN NULL ELSE value END AS value FROM grid),
        ranked AS (SELECT h.col, h.row, k.value, row_number() OVER (PARTITION BY h.col, h.row ORDER BY (h.col - k.col) * (h.col - k.col) + (h.row - k.row) * (h.row - k.row), k.row, k.col) AS rn
            FROM holey h JOIN holey k ON h.value IS NULL AND k.value IS NOT NULL AND k.col BETWEEN h.col - 6 AND h.col + 6 AND k.row BETWEEN h.row - 6 AND h.row + 6)
        SELECT * FROM holey WHERE value IS NOT NULL UNION ALL SELECT col, row, value FROM ranked WHERE rn = 1""",
)
def r11(spark, sf):
    holey = mean_grid(spark, sf).withColumn("value", F.when((F.col("col") + F.col("row")) % 7 != 3, F.col("value")))
    return R.fill_nearest(holey)


@query("R12_centroid_lookup", PIX.rstrip() + f", {GRID_SQL}, " + with_sql("parcels")[5:] + f"SELECT id_parcel, value FROM parcels LEFT JOIN grid ON col = floor((x0 + w / 2.0) / {RES}) AND row = floor((y0 + h / 2.0) / {RES})")
def r12(spark, sf):
    return R.centroid_lookup(parcels(spark, sf).select("id_parcel", "geometry"), mean_grid(spark, sf), 0, 0, RES).select("id_parcel", "value")


CENTRE_IN = f"(col + 0.5) * {RES} >= x0 AND (col + 0.5) * {RES} < x1 AND (row + 0.5) * {RES} >= y0 AND (row + 0.5) * {RES} < y1"


@query("R13_zonal_bare_soil", PIX.rstrip() + f", {GRID_SQL}, " + with_sql("parcels")[5:] + f"SELECT id_parcel, round(avg(CASE WHEN value < 25 THEN 1.0 ELSE 0.0 END), 9)::DOUBLE AS bare_soil, count(*) AS n_cells FROM parcels JOIN grid ON {CENTRE_IN} GROUP BY 1")
def r13(spark, sf):
    aggs = [F.round(R.bare_share("value", 25.0), 9).alias("bare_soil"), F.count("*").alias("n_cells")]
    return R.zonal(parcels(spark, sf), mean_grid(spark, sf), "id_parcel", aggs, 0, 0, RES, grid=CELL)


@query(
    "R14_zonal_all_touched",
    PIX.rstrip() + f", {GRID_SQL}, " + with_sql("parcels")[5:] + f"SELECT id_parcel, round(avg(value) + 1e-8, 5) AS mean, round(sum(value) + 1e-8, 4) AS total FROM parcels JOIN grid ON col * {RES} <= x1 AND (col + 1) * {RES} >= x0 AND row * {RES} <= y1 AND (row + 1) * {RES} >= y0 GROUP BY 1",
)
def r14(spark, sf):
    aggs = [F.round(F.avg("value") + 1e-8, 5).alias("mean"), F.round(F.sum("value") + 1e-8, 4).alias("total")]
    return R.zonal(parcels(spark, sf), mean_grid(spark, sf), "id_parcel", aggs, 0, 0, RES, all_touched=True, grid=CELL)


@query(
    "R15_rasterise",
    with_sql("parcels")
    + f"""SELECT col, row, round(sum(k % 100 * {RES * RES}.0::DOUBLE / (w * h)), 4) AS value FROM (SELECT p.*, c.col, r.row FROM parcels p, LATERAL (SELECT unnest(range(p.x0 // {RES}, p.x1 // {RES} + 1)) AS col) c, LATERAL (SELECT unnest(range(p.y0 // {RES}, p.y1 // {RES} + 1)) AS row) r) WHERE {CENTRE_IN} GROUP BY ALL""",
)
def r15(spark, sf):
    p = parcels(spark, sf).select((F.col("k") % 100).alias("v"), "geometry")
    return R.rasterise(p, "v", float(RES)).withColumn("value", F.round("value", 4))


@query("R16_point_samples", PIX.rstrip() + f", {GRID_SQL}, " + with_sql("trees")[5:] + f"SELECT k AS tree, value FROM trees JOIN grid ON col = x0 // {RES} AND row = y0 // {RES} AND col * {RES} // 1000 = x0 // 1000")
def r16(spark, sf):
    tile = F.floor(F.col("col") * RES / 1000)
    cells = mean_grid(spark, sf).withColumn("tile", tile)
    col, row = R.cell_of("x0", "y0", 0, 0, RES)
    t = layer(spark, sf, "trees").select(F.col("k").alias("tree"), col.alias("col"), row.alias("row"), F.floor(F.col("x0") / 1000).alias("tile"))
    return t.join(cells, ["tile", "col", "row"]).select("tree", "value")


SCENE_SQL = SCENES.format(date="strftime(o_orderdate, '%Y%m%d')")


def scenes(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    return spark.sql(SCENES.format(date="date_format(o_orderdate, 'yyyyMMdd')"))


@query(
    "R17_scene_search",
    f"SELECT o_orderkey, left(name, 3) AS mission, strptime(substr(name, 12, 15), '%Y%m%dT%H%M%S') AS captured, substr(name, 40, 5) AS tile FROM ({SCENE_SQL}) WHERE (substr(name, 12, 6) IN ('199711', '199712', '199801', '199802')) AND substr(name, 40, 5) = '30UXC'",
)
def r17(spark, sf):
    fields = R.scene_fields("name")
    s = scenes(spark, sf).select("o_orderkey", *[fields[c].alias(c) for c in ("mission", "captured", "tile")])
    return R.winter_scenes(s, 1998, "30UXC")


XML = "concat('<a><VEGETATION_PERCENTAGE>', CAST(o_orderkey % 50 AS varchar(20)), '</VEGETATION_PERCENTAGE><NOT_VEGETATED_PERCENTAGE>', CAST(o_orderkey % 37 AS varchar(20)), '</NOT_VEGETATED_PERCENTAGE><NODATA_PIXEL_PERCENTAGE>', CAST(o_orderkey % 90 AS varchar(20)), '</NODATA_PIXEL_PERCENTAGE><BOA_ADD_OFFSET band_id=\"3\">-', CAST(o_orderkey % 3 AS varchar(20)), '000</BOA_ADD_OFFSET></a>')"


@query(
    "R18_scene_usefulness",
    "SELECT o_orderkey, u AS usefulness, o AS \"offset\", 0.0::DOUBLE AS other, (min(rn) OVER (PARTITION BY u) + max(rn) OVER (PARTITION BY u)) / 2.0 <= 20 AS is_top FROM (SELECT *, row_number() OVER (ORDER BY u DESC) AS rn FROM (SELECT o_orderkey, round((o_orderkey % 50 + o_orderkey % 37) * (100 - o_orderkey % 90) / 10000.0::DOUBLE, 9) AS u, -1000.0::DOUBLE * (o_orderkey % 3) AS o FROM orders))",
)
def r18(spark, sf):
    docs = table(spark, sf, "orders").selectExpr("o_orderkey", f"{XML.replace('varchar(20)', 'string')} AS xml")
    scored = docs.select("o_orderkey", F.round(R.usefulness("xml"), 9).alias("usefulness"), (R.radiometric_offset("xml", 3) + 0.0).alias("offset"), R.radiometric_offset("xml", 4).alias("other"))
    # the documents are parsed once; ranking reads the scores several times
    return ranking.top_flag(SJ.durable(scored), "usefulness", "o_orderkey", 20, "is_top")


def tile_layer(spark, sf):
    """The 1 km tiles that parcels touch, as a layer."""
    listed = SJ.list_cells(parcels(spark, sf).select("geometry"), 1000.0, names=("tx", "ty")).select("tx", "ty").distinct()
    name = F.concat_ws("_", "tx", "ty")
    return listed.select(name.alias("tile"), G.rectangle(F.col("tx") * 1000, F.col("ty") * 1000, F.col("tx") * 1000 + 1000, F.col("ty") * 1000 + 1000).alias("geometry"))


TILE_SHARE = """shares AS (SELECT id_parcel, CAST(cx AS VARCHAR) || '_' || CAST(cy AS VARCHAR) AS tile,
    (least(q.x1, cx * 1000 + 1000) - greatest(q.x0, cx * 1000)) * (least(q.y1, cy * 1000 + 1000) - greatest(q.y0, cy * 1000)) / (q.w * q.h) AS proportion
    FROM (SELECT *, unnest(range(x0 // 1000, x1 // 1000 + 1)) AS cx FROM parcels) q, LATERAL (SELECT unnest(range(q.y0 // 1000, q.y1 // 1000 + 1)) AS cy))"""


@query("R19_tile_assignment", with_sql("parcels") + f", {TILE_SHARE} SELECT id_parcel, count(*) FILTER (proportion > 0.9) AS n_tiles, max(CASE WHEN proportion > 0.9 THEN tile END) AS tiles FROM parcels LEFT JOIN shares USING (id_parcel) GROUP BY 1")
def r19(spark, sf):
    shares = overlap.parcel_proportion(parcels(spark, sf), tile_layer(spark, sf), ["tile"], grid=CELL)
    found = R.tile_assignment(shares)
    return parcels(spark, sf).select("id_parcel").join(found, "id_parcel", "left").na.fill(0, ["n_tiles"])


@query(
    "R20_tiles_and_years",
    "SELECT l_orderkey AS id_parcel, " + ", ".join(f"max(CASE WHEN year(l_shipdate) = {y} THEN CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END END) AS bare_{y}" for y in (1996, 1997, 1998)) + " FROM lineitem GROUP BY 1",
)
def r20(spark, sf):
    li = table(spark, sf, "lineitem")
    bare = F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("bare")
    tiles = [li.where(F.col("l_suppkey") % 2 == i).select(F.col("l_orderkey").alias("id_parcel"), F.year("l_shipdate").alias("year"), bare) for i in (0, 1)]
    return R.combine_tiles_and_years(tiles[0].union(tiles[1]), "id_parcel", "year", "bare", [1996, 1997, 1998])


@query("R21_per_hectare", "SELECT p_partkey AS id_parcel, p_size / 100.0::DOUBLE AS n, p_retailprice / 100 AS p, (p_size * 2) / 100.0::DOUBLE AS k FROM part")
def r21(spark, sf):
    p = table(spark, sf, "part").withColumnRenamed("p_partkey", "id_parcel")
    n, ph, k = p.select("id_parcel", R.per_hectare("p_size").alias("n")), p.select("id_parcel", R.per_hectare("p_retailprice").alias("p")), p.select("id_parcel", R.per_hectare(F.col("p_size") * 2).alias("k"))
    return n.join(ph, "id_parcel").join(k, "id_parcel")


# -- H: rule pipelines -------------------------------------------------------------------

UPLAND = "SELECT c_custkey AS id_parcel, c_custkey % 3 = 0 AS is_upland FROM customer"
SOIL = "SELECT DISTINCT o_custkey AS id_parcel, o_orderkey % 31 + 1 AS unit, CAST(o_orderkey % 12 AS INT) AS habitat_code FROM orders"
NAMES = "CASE {v} % 7 WHEN 0 THEN 'Lowland Raised Bogs' WHEN 1 THEN 'Upland Fens' WHEN 2 THEN 'Blanket Bog' WHEN 3 THEN 'Purple Moor Grass & Rush Pastures' WHEN 4 THEN 'Upland Heathland' WHEN 5 THEN 'Coastal Saltmarsh' ELSE 'Lowland Meadows' END"
CLEAN = "rtrim(replace(replace(replace(replace(lower(habitat_name), '&', 'and'), ',', ''), 'calaminarian grass', 'calaminarian grassland'), 'grasslandland', 'grassland'), 's')"
LOOKUP = (
    "SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'phi' ELSE 'soilscapes' END AS source, CASE WHEN p_size % 4 < 2 THEN 'Create SRG' ELSE 'Create Wetland' END AS action_group,"
    f" p_type AS action_habitat, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 3 = 1 END AS is_upland, {NAMES.format(v='p_size')} AS habitat_name, CAST(p_size % 12 AS INT) AS habitat_code, CAST(p_size % 5 AS INT) AS soilscape_habitat_code FROM part"
)
AREAS = (
    f"SELECT l_partkey AS id_parcel, {NAMES.format(v='l_linenumber')} AS habitat_name, CASE l_suppkey % 3 WHEN 0 THEN 1000 WHEN 1 THEN 3000 ELSE 5000 END AS distance_threshold, CAST(sum(l_quantity) AS DOUBLE) AS area FROM lineitem GROUP BY 1, 2, 3"
)


def rule_inputs(spark, sf):
    for t in ("customer", "orders", "part", "lineitem"):
        table(spark, sf, t).createOrReplaceTempView(t)
    return tuple(spark.sql(q) for q in (UPLAND, SOIL, LOOKUP, AREAS))


H_CTES = f"""WITH upland AS ({UPLAND}), soil AS ({SOIL}), lookup AS ({LOOKUP}), areas AS ({AREAS}),
    cand AS (SELECT DISTINCT u.id_parcel, replace(l.action_group, 'Create ', '') AS action_group, l.action_habitat, u.is_upland, l.soilscape_habitat_code, s.unit
        FROM upland u JOIN soil s USING (id_parcel) JOIN lookup l USING (habitat_code) WHERE l.source = 'soilscapes' AND (l.is_upland IS NULL OR l.is_upland = u.is_upland)),
    phi AS (SELECT DISTINCT replace(action_group, 'Create ', '') AS action_group, action_habitat AS action_habitat_phi, {CLEAN} AS habitat_name, soilscape_habitat_code AS soilscape_habitat_code_phi FROM lookup WHERE source = 'phi'),
    near AS (SELECT p.*, a.id_parcel, a.distance_threshold, a.area, p.habitat_name IN ({', '.join(repr(n) for n in H.RARE)}) AND a.distance_threshold = 1000 AS nearby_rare_habitat
        FROM phi p JOIN (SELECT id_parcel, distance_threshold, area, {CLEAN} AS habitat_name FROM areas WHERE distance_threshold IN (1000, 3000)) a USING (habitat_name))"""


@query("H1_candidate_habitats", H_CTES + " SELECT * FROM cand")
def h1(spark, sf):
    upland, soil, lookup, _ = rule_inputs(spark, sf)
    return H.candidate_habitats(upland, soil, lookup)


@query("H2_nearby_habitats", H_CTES + " SELECT * FROM near")
def h2(spark, sf):
    _, _, lookup, areas = rule_inputs(spark, sf)
    return H.nearby_habitats(areas, lookup)


@query("H2_unknown_names", f"WITH lookup AS ({LOOKUP}), areas AS ({AREAS}) SELECT DISTINCT {CLEAN} AS habitat_name FROM lookup WHERE source = 'phi' AND {CLEAN} NOT IN (SELECT {CLEAN} FROM areas)")
def h2_unknown(spark, sf):
    _, _, lookup, areas = rule_inputs(spark, sf)
    return H.unknown_habitats(areas, lookup)


def assigned(spark, sf):
    upland, soil, lookup, areas = rule_inputs(spark, sf)
    return H.assign_habitats(H.candidate_habitats(upland, soil, lookup), H.nearby_habitats(areas, lookup))


H3_CTES = H_CTES + f""", matched AS (SELECT c.*, n.* EXCLUDE (id_parcel, action_group), c.action_habitat = n.action_habitat_phi AS ma, c.soilscape_habitat_code = n.soilscape_habitat_code_phi AS ms
        FROM cand c JOIN near n USING (id_parcel, action_group)),
    kept AS (SELECT id_parcel, unit, action_group, action_habitat, is_upland, NULL::BOOLEAN AS is_default, ma, ms, distance_threshold, nearby_rare_habitat, area FROM matched WHERE (ma OR action_group = 'SRG') AND (ms OR action_group = 'SRG')),
    dflt AS (SELECT id_parcel, unit, action_group, CASE WHEN is_upland THEN 'upland_' ELSE 'lowland_' END || CASE WHEN coalesce(habitat_name IN ({', '.join(repr(n) for n in H.ACID)}), false) THEN 'acid_gr' ELSE 'meadow' END AS action_habitat, is_upland
        FROM (SELECT c.*, n.habitat_name, row_number() OVER (PARTITION BY c.id_parcel, c.action_group ORDER BY n.distance_threshold ASC NULLS FIRST, n.area DESC NULLS LAST, n.habitat_name NULLS FIRST, c.unit) AS rn
        FROM cand c LEFT JOIN near n USING (id_parcel) WHERE c.action_group = 'SRG') WHERE rn = 1),
    every AS (SELECT * FROM kept UNION ALL SELECT id_parcel, unit, action_group, action_habitat, is_upland, true, NULL, NULL, NULL, NULL, NULL FROM dflt),
    final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_parcel, action_group ORDER BY ma DESC NULLS LAST, ms DESC NULLS LAST, distance_threshold ASC NULLS FIRST, nearby_rare_habitat DESC NULLS LAST, area DESC NULLS LAST, is_default DESC NULLS LAST, action_habitat, unit) AS rn FROM every) WHERE rn = 1)"""


@query("H3_assigned_habitats", H3_CTES + " SELECT id_parcel, unit, action_group, action_habitat FROM final")
def h3(spark, sf):
    return assigned(spark, sf).select("id_parcel", "unit", "action_group", "action_habitat")


@query("D7_assignment_invariants", 'SELECT * FROM (VALUES ' + ", ".join(f"('{c}', '{r}', 0::BIGINT)" for c, r in [*[(c, "not_null") for c in H.ASSIGNMENT.columns], *[("*", i) for i in H.ASSIGNMENT.invariants]]) + ') t("column", rule, failures) WHERE (SELECT count(*) FROM orders) > 0')
def d7(spark, sf):
    return H.check_assignment(assigned(spark, sf))


def _violations_sql() -> str:
    counts = {
        ("action_habitat", "not_null"): "(SELECT count(*) FROM final WHERE action_group <> 'SRG')",
        ("*", "no lowland habitat on upland"): "(SELECT count(*) FROM final WHERE is_default AND NOT is_upland AND action_group = 'SRG' AND action_habitat LIKE 'lowland%')",
        ("*", "no upland habitat on lowland"): "(SELECT count(*) FROM final WHERE is_default AND is_upland AND action_group = 'SRG' AND action_habitat LIKE 'upland%')",
    }
    rules = [*[(c, "not_null") for c in H.ASSIGNMENT.columns], *[("*", i) for i in H.ASSIGNMENT.invariants]]
    return H3_CTES + " " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", '{r}' AS rule, {counts.get((c, r), "0")}::BIGINT AS failures""" for c, r in rules)


@query("D7_assignment_violations", _violations_sql())
def d7_violations(spark, sf):
    """The invariants on a broken assignment: upland flags turned round, habitats missing outside one group."""
    habitat = F.when(F.col("action_group") == "SRG", F.col("action_habitat"))
    return H.check_assignment(assigned(spark, sf).withColumns({"is_upland": ~F.col("is_upland"), "action_habitat": habitat}))


@query(
    "H2_renamed_names",
    f"WITH raw AS ({LOOKUP}), areas AS ({AREAS}), lookup AS (SELECT CASE WHEN length(habitat_name) % 2 = 0 THEN habitat_name || ' old' ELSE habitat_name END AS habitat_name, source FROM raw) SELECT DISTINCT {CLEAN} AS habitat_name FROM lookup WHERE source = 'phi' AND {CLEAN} NOT IN (SELECT {CLEAN} FROM areas)",
)
def h2_renamed(spark, sf):
    """Lookup names that occur in no area row once every other name has changed."""
    _, _, lookup, areas = rule_inputs(spark, sf)
    name = F.when(F.length("habitat_name") % 2 == 0, F.concat("habitat_name", F.lit(" old"))).otherwise(F.col("habitat_name"))
    return H.unknown_habitats(areas, lookup.withColumn("habitat_name", name))


PHI = f"SELECT l_orderkey AS id_parcel, l_partkey AS fid, {NAMES.format(v='l_linenumber')} AS habitat_name, l_discount * 4 AS proportion FROM lineitem"
MANAGE = f"SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN 'Wetland' WHEN p_size % 3 = 1 THEN 'SRG' ELSE 'Coast' END AS action_group, p_type AS action_habitat, {NAMES.format(v='p_size')} AS habitat_name FROM part"


@query(
    "H4_existing_habitats",
    f"""WITH lookup AS ({LOOKUP}), phi AS ({PHI}), manage AS ({MANAGE}), area AS (SELECT o_orderkey AS id_parcel, o_totalprice / 10000 AS area_ha FROM orders),
    created AS (SELECT DISTINCT replace(action_group, 'Create ', '') AS action_group, action_habitat, {CLEAN} AS clean FROM lookup WHERE source = 'phi'),
    create_all AS (SELECT * FROM created UNION ALL SELECT action_group, 'action_group_total', clean FROM created),
    manage_all AS (SELECT * FROM manage UNION ALL SELECT action_group, 'action_group_total', habitat_name FROM manage UNION ALL SELECT 'Wetland and SRG', 'action_group_total', habitat_name FROM manage WHERE action_group IN ('Wetland', 'SRG')),
    long AS (SELECT id_parcel, 'raw' AS grouping_category, NULL AS action_group, habitat_name AS action_habitat, fid, proportion FROM phi
        UNION ALL SELECT p.id_parcel, 'create', c.action_group, c.action_habitat, p.fid, p.proportion FROM phi p JOIN create_all c ON {CLEAN.replace('habitat_name', 'p.habitat_name')} = c.clean
        UNION ALL SELECT p.id_parcel, 'manage', m.action_group, m.action_habitat, p.fid, p.proportion FROM phi p JOIN manage_all m USING (habitat_name)),
    once AS (SELECT id_parcel, grouping_category, action_group, action_habitat, fid, max(proportion) AS proportion FROM long GROUP BY ALL)
    SELECT id_parcel, grouping_category, action_group, action_habitat, round(p, 6) AS proportion, round(area_ha * p + 1e-7, 4) AS habitat_area_ha FROM (
        SELECT id_parcel, grouping_category, action_group, action_habitat, least(greatest(sum(proportion), 0), 1) AS p FROM once GROUP BY ALL) JOIN area USING (id_parcel) WHERE p > 0""",
)
def h4(spark, sf):
    _, _, lookup, _ = rule_inputs(spark, sf)
    area = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id_parcel"), (F.col("o_totalprice") / 10000).alias("area_ha"))
    out = H.existing_habitats(area, spark.sql(PHI), lookup, spark.sql(MANAGE))
    return out.withColumns({"proportion": F.round("proportion", 6), "habitat_area_ha": F.round(F.col("habitat_area_ha") + 1e-7, 4)})


MATRIX = "SELECT n_nationkey AS unit, " + ", ".join(f"CASE WHEN (n_nationkey * {i + 2}) % 5 = 0 THEN 1 WHEN n_nationkey % 3 = 0 THEN 0 END AS h{i}" for i in range(6)) + " FROM nation"


@query("H5_soil_habitats", f"SELECT s_suppkey AS id_parcel, s_nationkey AS unit, habitat_code FROM supplier JOIN (SELECT unit, habitat_code, tick FROM ({MATRIX}) UNPIVOT (tick FOR habitat_code IN (h0, h1, h2, h3, h4, h5))) ON unit = s_nationkey WHERE tick != 0")
def h5(spark, sf):
    table(spark, sf, "nation").createOrReplaceTempView("nation")
    soils = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id_parcel"), F.col("s_nationkey").alias("unit"))
    return H.soil_habitats(soils, spark.sql(MATRIX)).select("id_parcel", "unit", "habitat_code")


FLOW_EXPRS = [
    "k", "CASE WHEN k % 9 = 0 THEN NULL ELSE concat(CAST(k % 5 + 1 AS varchar(20)), ' - catchment') END AS CatchmentRiskDesc",
    "concat(CAST(k % 4 AS varchar(20)), ' - use') AS LandUseRisk", "concat(CAST(k % 4 + 1 AS varchar(20)), ' - slope') AS SlopeRisk",
    "concat(CAST(k % 3 + 1 AS varchar(20)), ' - soil') AS CombinedSoilRisk", "CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 50 AS DOUBLE) / 10 END AS MeanRainfalRisk", "(k * 37) % 1009 AS MaxFlowAcc",
]


@query(
    "H6_erosion_scores",
    with_sql("parcels", "hedges")
    + f""", flow AS (SELECT {', '.join(FLOW_EXPRS)}, x0, y0, x1, y1 FROM hedges),
    scored AS (SELECT *, CASE WHEN k % 9 = 0 THEN 0 ELSE k % 5 + 1 END AS c, k % 4 AS l, CASE k % 4 + 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 5 END AS s, k % 3 + 1 AS o,
        ntile(5) OVER (ORDER BY coalesce(MeanRainfalRisk, 0), k) AS r, ntile(5) OVER (ORDER BY coalesce(MaxFlowAcc, 0), k) AS a FROM flow),
    worst AS (SELECT p.id_parcel, max(c + l + s + o + r + a) AS t, max(c) AS c, max(l) AS l, max(s) AS s, max(o) AS o, max(r) AS r, max(a) AS a FROM parcels p JOIN scored f ON {MEET} GROUP BY 1)
    SELECT id_parcel, CAST(ntile(5) OVER (ORDER BY t, id_parcel) AS TINYINT) AS erosion_score, CAST(c AS TINYINT) AS CatchmentQuintile, CAST(l AS TINYINT) AS LandUseQuintile, CAST(s AS TINYINT) AS SlopeQuintile,
        CAST(o AS TINYINT) AS CombinedSoilQuintile, CAST(r AS TINYINT) AS MeanRainfallQuintile, CAST(a AS TINYINT) AS MaxFlowAccQuintile FROM worst""",
)
def h6(spark, sf):
    flows = layer(spark, sf, "hedges").selectExpr(*[e.replace("varchar(20)", "string") for e in FLOW_EXPRS], "geometry")
    p = parcels(spark, sf).select("id_parcel", F.col("k").alias("tie"), "geometry")
    scored = H.erosion_scores(p, flows, "k", "tie", CELL)
    return scored


TILE_SCENARIOS = (
    "SELECT p_partkey % 400 AS tile, p_type AS woodland_type, period, years, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS species_1, p_name AS species_2, CAST(p_size % 10 AS DOUBLE) / 10 AS area_1, CAST(p_size % 7 AS DOUBLE) / 10 AS area_2,"
    " CAST(p_size % 5 AS DOUBLE) AS yield_class_1, CAST(p_size % 6 AS DOUBLE) AS yield_class_2, CAST(p_size % 3 AS DOUBLE) AS suitability_1, CAST(p_size % 4 AS DOUBLE) AS suitability_2, CAST(p_size % 9 AS DOUBLE) / 10 AS open_space,"
    " CASE WHEN p_partkey % 400 % 10 = 0 THEN 0.0 ELSE CAST(p_size * 3 - years AS DOUBLE) END AS carbon_tree, CASE WHEN p_partkey % 400 % 10 = 0 THEN 0.0 ELSE CAST(p_size + 1 AS DOUBLE) END AS carbon_soil"
    " FROM part CROSS JOIN (VALUES ('2021_2028', 8), ('2021_2050', 30)) AS t(period, years)"
)
PARCEL_TILES = "SELECT o_orderkey AS id_parcel, o_custkey % 400 AS tile, CAST(o_orderkey % 13 AS DOUBLE) AS area FROM orders UNION ALL SELECT o_orderkey, (o_custkey + 1) % 400, CAST(o_orderkey % 7 AS DOUBLE) FROM orders"


def woodland(spark, sf):
    for t in ("part", "orders"):
        table(spark, sf, t).createOrReplaceTempView(t)
    per_tile = spark.sql(TILE_SCENARIOS).groupBy("tile", "woodland_type", "period").agg(
        *[F.max(c).alias(c) for c in ("species_1", "species_2")],
        *[F.round(F.avg(c), 6).alias(c) for c in ("area_1", "area_2", "yield_class_1", "yield_class_2", "suitability_1", "suitability_2", "open_space", "carbon_tree", "carbon_soil")],
    )
    return per_tile, spark.sql(PARCEL_TILES)


TILES_CTE = (
    f"WITH raw AS ({TILE_SCENARIOS}), ptiles AS ({PARCEL_TILES}), tiles AS (SELECT tile, woodland_type, period, max(species_1) AS species_1, max(species_2) AS species_2, "
    + ", ".join(f"round(avg({c}), 6) AS {c}" for c in ("area_1", "area_2", "yield_class_1", "yield_class_2", "suitability_1", "suitability_2", "open_space", "carbon_tree", "carbon_soil"))
    + " FROM raw GROUP BY ALL)"
)


LIVE_CTE = """, live AS (SELECT tile, woodland_type FROM tiles GROUP BY ALL HAVING round(sum(carbon_tree), 9) <> 0 OR round(sum(carbon_soil), 9) <> 0),
    usable AS (SELECT tiles.* FROM tiles JOIN live USING (tile, woodland_type) WHERE species_1 IS NOT NULL OR species_2 IS NOT NULL)"""


@query(
    "H7_woodland_carbon",
    TILES_CTE
    + LIVE_CTE
    + """
    SELECT id_parcel, woodland_type, period, round(sum(area * carbon_tree) / sum(area) + 1e-7, 4) AS carbon_tree, round(sum(area * carbon_soil) / sum(area) + 1e-7, 4) AS carbon_soil FROM ptiles JOIN usable USING (tile) WHERE area > 0 GROUP BY ALL""",
)
def h7(spark, sf):
    per_tile, ptiles = woodland(spark, sf)
    out = H.woodland_carbon(per_tile, ptiles, "tile", ["woodland_type", "period"], ["carbon_tree", "carbon_soil"], ["species_1", "species_2"], 9)
    return out.withColumns({c: F.round(F.col(c) + 1e-7, 4) for c in ("carbon_tree", "carbon_soil")})


@query(
    "H7_woodland_species",
    TILES_CTE
    + LIVE_CTE
    + """, long AS (SELECT tile, woodland_type, period, species_1 AS species, area_1 AS share, yield_class_1 AS yield_class, suitability_1 AS suitability FROM usable UNION ALL SELECT tile, woodland_type, period, species_2, area_2, yield_class_2, suitability_2 FROM usable
        UNION ALL SELECT tile, woodland_type, period, 'OPENSPACE', open_space, NULL, NULL FROM usable)
    SELECT id_parcel, woodland_type, period, species, round(sum(area * share) / sum(area) + 1e-7, 4) AS share, round(sum(area * yield_class) / sum(area) + 1e-7, 4) AS yield_class, round(sum(area * suitability) / sum(area) + 1e-7, 4) AS suitability
        FROM ptiles JOIN long USING (tile) WHERE species IS NOT NULL AND area > 0 GROUP BY ALL""",
)
def h7_species(spark, sf):
    per_tile, ptiles = woodland(spark, sf)
    out = H.woodland_species(per_tile, ptiles, "tile", ["woodland_type", "period"], ["carbon_tree", "carbon_soil"], 2, 9)
    return out.withColumns({c: F.round(F.col(c) + 1e-7, 4) for c in ("share", "yield_class", "suitability")})


@query(
    "H8_farm_info",
    with_sql("parcels") + f", {FARMS_SQL} SELECT p.id_business, string_agg(DISTINCT id_parcel, ',' ORDER BY id_parcel) AS id_parcels, round(sum(w * h) / 10000.0::DOUBLE, 6) AS area_ha, round(avg(x0 + w / 2.0), 6) AS x, round(avg(y0 + h / 2.0), 6) AS y, any_value({ARABLE_SQL})::DOUBLE AS ha_arable, any_value({GRASS_SQL})::DOUBLE AS ha_grassland FROM parcels p JOIN farms f ON p.id_business = f.id_business GROUP BY 1",
)
def h8(spark, sf):
    c = G.centroid("geometry")
    p = parcels(spark, sf)
    located = p.select("id_parcel", (G.area("geometry") / 10000).alias("area_ha"), c["x"].alias("x"), c["y"].alias("y"))
    out = H.farm_info(located, p.select("id_parcel", "id_business"), farms(spark, sf), [f"ha_{a}" for a in ARABLE], [f"ha_{g}" for g in GRASSLAND])
    return out.withColumns({k: F.round(k, 6) for k in ("area_ha", "x", "y")})


@query("H9_land_cover", "SELECT l_orderkey AS id_parcel, p_name AS land_cover_name, CAST(sum(l_quantity) AS DOUBLE) AS area, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS land_cover_codes FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def h9(spark, sf):
    covers = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id_parcel"), F.col("l_partkey").alias("land_cover_code"), F.col("l_quantity").alias("area"))
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("land_cover_code"), F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("land_cover_name"))
    return H.land_cover(covers, names)


@query("H10_grid_and_geojson", with_sql("parcels") + """SELECT id_parcel, CAST(floor(x0 + w / 2.0) AS INT) AS x, CAST(floor(y0 + h / 2.0) AS INT) AS y, left(id_parcel, 6) AS tile_1km, '{"type":"Point","coordinates":[' || x0 || ',' || y0 || ']}' AS geojson, f.o_orderstatus AS status FROM parcels LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') f ON f.o_orderkey = k""")
def h10(spark, sf):
    c = G.centroid("geometry")
    p = parcels(spark, sf).select("k", "id_parcel", F.floor(c["x"]).cast("int").alias("x"), F.floor(c["y"]).cast("int").alias("y"), X.parcel_grid_names("id_parcel")["tile_1km"].alias("tile_1km"), C.to_geojson(G.point("x0", "y0")).alias("geojson"))
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return p.join(o, "k", "left").drop("k")


@query("H11_prefix_category", with_sql("parcels") + "SELECT id_business, split_part(o_orderpriority, '-', 1) AS category, count(*) AS n_parts, CAST(sum(w * h) AS DOUBLE) AS area FROM parcels JOIN orders ON k = o_orderkey GROUP BY ALL")
def h11(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.split("o_orderpriority", "-")[0].alias("category"))
    multi = parcels(spark, sf).join(o, "k").groupBy("id_business", "category").agg(G.collect_multipart("geometry").alias("geometry"))
    single = linear.dump_parts(multi)
    return single.groupBy("id_business", "category").agg(F.count("*").alias("n_parts"), F.sum(G.area("geometry")).alias("area"))


@query(
    "H12_conclusive_flag",
    with_sql("parcels", "features") + ", flagged AS (SELECT class IN ('A', 'N') AS conclusive, x0, y0, x1, y1 FROM features), "
    + union_area_sql(f"SELECT p.id_parcel, f.conclusive, {CUT} FROM parcels p JOIN flagged f ON {MEET}", "id_parcel, conclusive")
    + ", met AS (SELECT DISTINCT id_parcel, conclusive FROM pairs) SELECT id_parcel, conclusive, round(coalesce(area, 0) / (w * h), 9) AS proportion FROM met LEFT JOIN areas USING (id_parcel, conclusive) JOIN parcels USING (id_parcel)",
)
def h12(spark, sf):
    out = overlap.parcel_proportion(parcels(spark, sf), layer(spark, sf, "features"), ["conclusive"], pre=lambda df: df.withColumn("conclusive", F.col("class").isin("A", "N")), grid=CELL)
    return out.withColumn("proportion", F.round("proportion", 9))


@query(
    "H13_water_merge",
    with_sql("water", "hedges") + ", merged AS (SELECT CASE WHEN w < 30 AND h < 10 THEN 'ditch' WHEN h < 12 THEN 'watercourse' ELSE 'waterbody' END AS class, w * h AS a, 2 * (w + h) AS m FROM water UNION ALL SELECT 'ditch', 0, w + h FROM hedges WHERE kind = 'MACHINERY') SELECT class, count(*) AS n, CAST(sum(a) AS DOUBLE) AS area, CAST(sum(m) AS DOUBLE) AS m FROM merged GROUP BY 1",
)
def h13(spark, sf):
    """Two sources classified, united, cut into small pieces, cleaned and keyed."""
    kind = F.expr("CASE WHEN w < 30 AND h < 10 THEN 'ditch' WHEN h < 12 THEN 'watercourse' ELSE 'waterbody' END")
    water = layer(spark, sf, "water").select(kind.alias("class"), "geometry")
    drains = layer(spark, sf, "hedges").where("kind = 'MACHINERY'").select(F.lit("ditch").alias("class"), "geometry")
    pieces = water.union(drains).select("class", F.explode(S.subdivide("geometry", 256)).alias("geometry"))
    keyed = pieces.withColumn("geometry", S.clean("geometry")).withColumn("fid", X.stable_key("class", "geometry.xmin", "geometry.ymin", "geometry.xmax"))
    return keyed.groupBy("class").agg(F.count("fid").alias("n"), F.sum(G.area("geometry")).alias("area"), F.sum(G.length("geometry")).alias("m"))


@query(
    "H14_boundary_uses",
    _o15_ctes() + ", used AS (SELECT id_parcel, b - a AS len, CASE WHEN bool_water THEN 'water' WHEN bool_hedgerow THEN 'hedgerow' WHEN bool_wall THEN 'wall' ELSE 'none' END AS use FROM flagged JOIN segments USING (id_boundary)) SELECT id_parcel, "
    + ", ".join(f"round(coalesce(sum(CASE WHEN use = '{u}' THEN len END), 0), 4) AS m_{u}" for u in [*USES, "none"]) + ", round(sum(len), 4) AS m FROM used GROUP BY 1",
)
def h14(spark, sf):
    s, spans = use_spans(spark, sf)
    pieces = linear.allocate_by_priority(linear.divide_by_use(spans, USES, s), ["water", "hedgerow", "wall"])
    joined = s.select("id_boundary", "id_parcel").join(SJ.unbroadcast(pieces), "id_boundary", "left")
    sums = [F.round(F.coalesce(F.sum(F.when(F.col("use") == u, F.col("m"))), F.lit(0.0)), 4).alias(f"m_{u}") for u in [*USES, "none"]]
    return joined.groupBy("id_parcel").agg(*sums, F.round(F.sum("m"), 4).alias("m"))


@query(
    "H15_tree_suite",
    with_sql("parcels", "trees", "hedges", "water")
    + f""", perim AS (SELECT p.id_parcel, count(*) AS n FROM parcels p JOIN trees f ON {near(4)} AND NOT (f.x0 > p.x0 + 4 AND f.x0 < p.x1 - 4 AND f.y0 > p.y0 + 4 AND f.y0 < p.y1 - 4) GROUP BY 1),
    inn AS (SELECT p.id_parcel, count(*) AS n FROM parcels p JOIN trees f ON f.x0 > p.x0 + 4 AND f.x0 < p.x1 - 4 AND f.y0 > p.y0 + 4 AND f.y0 < p.y1 - 4 GROUP BY 1),
    byh AS (SELECT p.k, count(*) AS n FROM trees p WHERE EXISTS (SELECT 1 FROM hedges f WHERE {near(4)}) GROUP BY 1),
    byw AS (SELECT p.k, count(*) AS n FROM trees p WHERE EXISTS (SELECT 1 FROM water f WHERE {near(4)}) GROUP BY 1),
    touch AS (SELECT p.id_parcel, f.k FROM parcels p JOIN trees f ON {near(4)})
    SELECT id_parcel, coalesce(perim.n, 0) AS n_perimeter, coalesce(inn.n, 0) AS n_interior, coalesce(h.n, 0) AS n_hedgerow, coalesce(w.n, 0) AS n_waterbody FROM parcels LEFT JOIN perim USING (id_parcel) LEFT JOIN inn USING (id_parcel)
        LEFT JOIN (SELECT id_parcel, count(*) AS n FROM touch JOIN byh USING (k) GROUP BY 1) h USING (id_parcel) LEFT JOIN (SELECT id_parcel, count(*) AS n FROM touch JOIN byw USING (k) GROUP BY 1) w USING (id_parcel)""",
)
def h15(spark, sf):
    """Trees of every parcel by place: outline, inside, by a hedge, by water."""
    p = parcels(spark, sf).select("id_parcel", "geometry")
    t = layer(spark, sf, "trees").select(F.col("k").alias("tree"), "geometry")
    near4 = SJ.sjoin(p, t, 4, CELL).select("id_parcel", "tree")
    rim = SJ.sjoin(segments(spark, sf).select("id_parcel", "geometry"), t, 4, CELL).select("id_parcel", "tree").distinct()
    tagged = near4.join(rim.withColumn("on_rim", F.lit(True)), ["id_parcel", "tree"], "left")
    for name in ("hedges", "water"):
        hit = SJ.sjoin(t, layer(spark, sf, name).select("geometry"), 4, CELL).select("tree").distinct()
        tagged = tagged.join(hit.withColumn(f"by_{name}", F.lit(True)), "tree", "left")
    rim_col = F.coalesce("on_rim", F.lit(False))
    counts = tagged.groupBy("id_parcel").agg(
        F.count_if(rim_col).alias("n_perimeter"), F.count_if(~rim_col).alias("n_interior"), F.count_if("by_hedges").alias("n_hedgerow"), F.count_if("by_water").alias("n_waterbody")
    )
    return p.select("id_parcel").join(counts, "id_parcel", "left").na.fill(0)


@query(
    "H16_habitat_on_protected",
    with_sql("parcels", "features", "water", "hedges")
    + f""", a AS (SELECT f.class AS habitat, sum(({SHARED})) / 10000.0::DOUBLE AS ha FROM water p JOIN features f ON {MEET} GROUP BY 1),
    l AS (SELECT f.kind AS habitat, sum(greatest(least(p.x1, f.x1) - greatest(p.x0, f.x0), 0) + greatest(least(p.y1, f.y1) - greatest(p.y0, f.y0), 0))::DOUBLE AS m FROM water p JOIN hedges f ON {MEET} GROUP BY 1)
    SELECT habitat, round(ha, 6) AS ha, m FROM a FULL JOIN l USING (habitat)""",
)
def h16(spark, sf):
    """Protected ground (water) against areal and linear habitats."""
    zones = layer(spark, sf, "water").select("geometry")
    areal = overlap.overlap(zones, layer(spark, sf, "features").select(F.col("class").alias("habitat"), "geometry"), CELL)
    ha = areal.groupBy("habitat").agg(F.round(F.sum("area") / 10000, 6).alias("ha"))
    lines = layer(spark, sf, "hedges").select(F.col("kind").alias("habitat"), "geometry")
    pairs = SJ.sjoin(zones, lines, grid=CELL)
    a, b = F.col("geometry_left"), F.col("geometry_right")
    run = F.greatest(F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"]), F.lit(0.0)) + F.greatest(F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"]), F.lit(0.0))
    m = pairs.groupBy("habitat").agg(F.sum(run).alias("m"))
    return ha.join(m, "habitat", "outer")


@query(
    "H17_area_reconciliation",
    O2_SQL + "SELECT class, round(coalesce(by_share, 0), 4) AS by_overlap, round(coalesce(attr, 0), 4) AS by_attribute, round(coalesce(by_share, 0) - coalesce(attr, 0), 4) AS difference FROM (SELECT class, sum(proportion * w * h) / 10000.0::DOUBLE AS by_share FROM shares JOIN parcels USING (id_parcel) GROUP BY 1) FULL JOIN (SELECT class, sum(w * h) / 10000.0::DOUBLE AS attr FROM features GROUP BY 1) USING (class)",
)
def h17(spark, sf):
    p = parcels(spark, sf).select("id_parcel", (G.area("geometry") / 10000).alias("ha"))
    share = o2_frame(spark, sf).join(p, "id_parcel").groupBy("class").agg(F.sum(F.col("proportion") * F.col("ha")).alias("a"))
    attr = layer(spark, sf, "features").groupBy("class").agg(F.sum(G.area("geometry") / 10000).alias("b"))
    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return share.join(attr, "class", "outer").select("class", F.round(a, 4).alias("by_overlap"), F.round(b, 4).alias("by_attribute"), F.round(a - b, 4).alias("difference"))


@query(
    "H18_year_on_year",
    with_sql("parcels") + "SELECT id_parcel, old, new, coalesce(new, 0) - coalesce(old, 0) AS change FROM (SELECT id_parcel, CAST(w * h AS DOUBLE) AS old FROM parcels WHERE k % 10 != 0) FULL JOIN (SELECT id_parcel, CAST((w + k % 3) * h AS DOUBLE) AS new FROM parcels WHERE k % 11 != 0) USING (id_parcel)",
)
def h18(spark, sf):
    p = parcels(spark, sf)
    old = p.where("k % 10 != 0").select("id_parcel", G.area("geometry").alias("old"))
    grown = G.rectangle("x0", "y0", F.col("x0") + F.col("w") + F.col("k") % 3, F.col("y0") + F.col("h"))
    new = p.where("k % 11 != 0").select("id_parcel", G.area(grown).alias("new"))
    return old.join(new, "id_parcel", "outer").withColumn("change", F.coalesce("new", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))


@query(
    "H19_stratified_sample",
    "SELECT o_orderstatus AS stratum, count(*) AS n, count(*) FILTER (substr(h, 1, 2) < CASE o_orderstatus WHEN 'P' THEN '80' WHEN 'F' THEN '40' ELSE '20' END) AS n_sampled FROM (SELECT *, sha256(concat_ws('-', CAST(o_orderkey AS VARCHAR), '42')) AS h FROM orders) GROUP BY 1",
)
def h19(spark, sf):
    """A seeded sample per stratum that does not depend on row order: a hash of the key against the stratum's fraction."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("stratum"), X.short_hash("o_orderkey", F.lit(42), length=2).alias("h"))
    limit = F.when(F.col("stratum") == "P", "80").when(F.col("stratum") == "F", "40").otherwise("20")
    return o.groupBy("stratum").agg(F.count("*").alias("n"), F.count_if(F.col("h") < limit).alias("n_sampled"))


@query(
    "H20_distribution_moments",
    "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM lineitem JOIN (SELECT l_returnflag AS f, avg(pow(l_quantity - mu, 2)) AS m2, avg(pow(l_quantity - mu, 3)) AS m3, avg(pow(l_quantity - mu, 4)) AS m4 FROM lineitem JOIN (SELECT l_returnflag AS g, avg(l_quantity) AS mu FROM lineitem GROUP BY 1) ON g = l_returnflag GROUP BY 1) ON f = l_returnflag GROUP BY l_returnflag, m2, m3, m4",
)
def h20(spark, sf):
    q = "l_quantity"
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev(q), 6).alias("std"), F.round(F.skewness(q), 6).alias("skewness"), F.round(F.kurtosis(q), 6).alias("kurtosis")
    )
