"""Scalar function and geometry column queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.functions import shapes as S
from landgrain.functions import text as X
from landgrain.operators import linear, reference_grid
from landgrain.operators.scanlines import cells
from landgrain.plans.book import query
from landgrain.plans.fixtures import layer, spread, table, with_sql

# -- F: scalars ------------------------------------------------------------------


@query("F1_slices", "SELECT c_custkey, left(c_name, 4) AS l, right(c_name, 5) AS r, substring(c_name, 10, length(c_name) - 12) AS m FROM customer")
def f1(spark, sf):
    n = F.col("c_name")
    return table(spark, sf, "customer").select("c_custkey", F.left(n, F.lit(4)).alias("l"), F.right(n, F.lit(5)).alias("r"), F.substring(n, F.lit(10), F.length(n) - 12).alias("m"))


@query("F2_concat", "SELECT p_partkey, concat(p_brand, '/', p_type) AS a, concat_ws('-', p_type, NULL, p_name) AS b FROM part")
def f2(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("a"), F.concat_ws("-", "p_type", F.lit(None), "p_name").alias("b"))


HABITAT_NAME = "concat('Purple Moor ', p_name, CASE WHEN p_size % 3 = 0 THEN 's & Rush Pastures' WHEN p_size % 3 = 1 THEN ', Calaminarian Grass' ELSE 'ss' END)"


@query(
    "F3_clean_names",
    f"SELECT p_partkey, rtrim(replace(replace(replace(replace(lower({HABITAT_NAME}), '&', 'and'), ',', ''), 'calaminarian grass', 'calaminarian grassland'), 'grasslandland', 'grassland'), 's') AS name FROM part",
)
def f3(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey", f"{HABITAT_NAME} AS raw").select("p_partkey", X.clean_name("raw").alias("name"))


@query("F4_replace_trim", "SELECT o_orderkey, trim(replace(concat('  ', o_orderpriority, ' '), 'URGENT', 'now')) AS p FROM orders")
def f4(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.trim(F.replace(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")), F.lit("URGENT"), F.lit("now"))).alias("p"))


LABELS = "concat(p_name, ',', p_type, ', ', p_brand)"


@query("F5_split_labels", f"SELECT p_partkey, unnest(string_split({LABELS}, ',')) AS label FROM part")
def f5(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey", f"{LABELS} AS v").select("p_partkey", F.explode(X.split_labels("v")).alias("label"))


@query("F6_regex_extract", "SELECT page_id, regexp_extract(url, 'example\\.com/(\\w+)/(\\d+)', 1) AS lang, regexp_extract(url, 'example\\.com/(\\w+)/(\\d+)', 2) AS num FROM pages")
def f6(spark, sf):
    rx = r"example\.com/(\w+)/(\d+)"
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", rx, 1).alias("lang"), F.regexp_extract("url", rx, 2).alias("num"))


PACKED = "concat('\"kind\"=>\"', event_type, '\",\"user\"=>\"', CAST(user_id AS varchar(20)), '\",\"surface\"=>\"grass\"')"


@query(
    "F7_find_pairs",
    f"SELECT event_id, unnest(regexp_extract_all({PACKED}, '\"([^\"]*)\"=>\"([^\"]*)\"', 1)) AS key, unnest(regexp_extract_all({PACKED}, '\"([^\"]*)\"=>\"([^\"]*)\"', 2)) AS value FROM events",
)
def f7(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", f"{PACKED.replace('varchar(20)', 'string')} AS tags")
    rx = F.lit('"([^"]*)"=>"([^"]*)"')
    pairs = F.arrays_zip(F.regexp_extract_all("tags", rx, 1).alias("key"), F.regexp_extract_all("tags", rx, 2).alias("value"))
    return e.select("event_id", F.inline(pairs))


@query("F8_like_family", "SELECT p_partkey, p_name LIKE '%bolt' AS a, p_name NOT LIKE 'red%' AS b, starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2') AS c FROM part")
def f8(spark, sf):
    n, b = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select("p_partkey", n.like("%bolt").alias("a"), (~n.like("red%")).alias("b"), (b.startswith("Brand#1") | b.startswith("Brand#2")).alias("c"))


CAMEL = "concat('Field', p_type, ' ', p_name, '--', p_brand)"


@query(
    "F9_snake_case",
    f"SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(regexp_replace({CAMEL}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM part",
)
def f9(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey", f"{CAMEL} AS v").select("p_partkey", X.snake_case("v").alias("name"))


@query(
    "F10_path_template",
    "SELECT page_id, nullif(regexp_extract(url, '^http://(.+?)\\.example\\.com/(.+?)/(.+?)$', 1), '') AS host, nullif(regexp_extract(url, '^http://(.+?)\\.example\\.com/(.+?)/(.+?)$', 2), '') AS lang, nullif(regexp_extract(url, '^http://(.+?)\\.example\\.com/(.+?)/(.+?)$', 3), '') AS rest FROM pages",
)
def f10(spark, sf):
    m = X.parse_template("url", "http://{host}.example.com/{lang}/{rest}")
    return table(spark, sf, "pages").select("page_id", m.alias("m")).select("page_id", *[F.col("m")[k].alias(k) for k in ("host", "lang", "rest")])


@query(
    "F11_leading_score",
    "SELECT o_orderkey, coalesce(TRY_CAST(regexp_extract(o_orderpriority, '^\\s*([0-9]+)', 1) AS INT), 0) AS score, CASE TRY_CAST(regexp_extract(o_orderpriority, '^\\s*([0-9]+)', 1) AS INT) WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 5 END AS slope FROM orders",
)
def f11(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.leading_score(F.col("o_orderpriority")).alias("score"), X.slope_score("o_orderpriority").alias("slope"))


@query(
    "F12_math",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / 3, 2) AS r, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS f, least(l_quantity, l_linenumber * 10.0::DOUBLE) AS lo, greatest(l_tax, l_discount) AS hi, abs(l_tax - l_discount) AS d, l_quantity / nullif(l_linenumber - 1, 0) AS q FROM lineitem",
)
def f12(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(c("l_extendedprice") / 3, 2).alias("r"), F.floor(c("l_extendedprice") / 1000).alias("f"),
        F.least(c("l_quantity"), c("l_linenumber") * F.lit(10.0)).alias("lo"), F.greatest("l_tax", "l_discount").alias("hi"), F.abs(c("l_tax") - c("l_discount")).alias("d"),
        F.try_divide(c("l_quantity"), c("l_linenumber") - 1).alias("q"),
    )


TRI = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END"


@query("F13_null_logic", f"SELECT o_orderkey, t OR o_orderstatus = 'F' AS either, t AND o_orderstatus = 'F' AS both, coalesce(t, false) AS known, t IS NULL AS missing FROM (SELECT *, {TRI} AS t FROM orders)")
def f13(spark, sf):
    t, f = F.col("t"), F.col("o_orderstatus") == "F"
    return table(spark, sf, "orders").selectExpr("*", f"{TRI} AS t").select(
        "o_orderkey", (t | f).alias("either"), (t & f).alias("both"), F.coalesce(t, F.lit(False)).alias("known"), t.isNull().alias("missing")
    )


@query(
    "F14_tag_map",
    "SELECT event_id, '{' || CASE WHEN user_id % 3 = 0 THEN '\"highway\":\"path\",' ELSE '' END || '\"barrier\":\"' || event_type || '\",\"user\":\"' || CAST(user_id AS VARCHAR) || '\"}' AS tags FROM events",
)
def f14(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("user_id") % 3 == 0, "path").alias("highway"),
        F.col("event_type").alias("barrier"),
        F.concat(F.lit('"user"=>"'), F.col("user_id").cast("string"), F.lit('","barrier"=>"other"')).alias("other_tags"),
    )
    return e.select("event_id", F.to_json(X.tag_map(["highway", "barrier"], "other_tags")).alias("tags"))


@query("F15_arrays", "SELECT o_orderkey, v FROM (SELECT o_orderkey, unnest([o_custkey, o_orderkey % 7, 3]) AS v FROM orders)")
def f15(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.explode(F.sort_array(F.array("o_custkey", F.col("o_orderkey") % 7, F.lit(3).cast("long")))).alias("v"))


@query("F16_json_out", "SELECT c_custkey, '{\"id\":' || CAST(c_custkey AS VARCHAR) || ',\"segment\":\"' || c_mktsegment || '\"}' AS doc FROM customer")
def f16(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))).alias("doc"))


@query("F17_timestamps", "SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y%m%d') || '134501', '%Y%m%d%H%M%S') AS stamp, month(o_orderdate) IN (11, 12, 1, 2) AS is_winter FROM orders")
def f17(spark, sf):
    o = table(spark, sf, "orders").withColumn("text", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("134501")))
    return o.select("o_orderkey", X.parse_stamp("text").alias("stamp"), F.month("o_orderdate").isin(11, 12, 1, 2).alias("is_winter"))


@query("F18_casts", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice + 0.5) AS INT) AS i, CAST(l_linestatus = 'F' AS DOUBLE) AS b, CAST(l_linenumber AS TINYINT) AS t, TRY_CAST(l_returnflag AS INT) AS n FROM lineitem")
def f18(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.floor(c("l_extendedprice") + 0.5).cast("int").alias("i"), (c("l_linestatus") == "F").cast("double").alias("b"), c("l_linenumber").cast("tinyint").alias("t"), c("l_returnflag").try_cast("int").alias("n")
    )


@query("F19_short_hash", "SELECT o_orderkey, left(sha256(concat_ws('-', CAST(o_orderkey AS VARCHAR), o_orderstatus)), 8) AS h FROM orders")
def f19(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.short_hash("o_orderkey", "o_orderstatus").alias("h"))


@query("F20_stable_keys", "SELECT l_returnflag, count(*) AS n, count(*) AS n_keys FROM (SELECT DISTINCT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY 1")
def f20(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey").distinct()
    keyed = rows.withColumn("key", X.stable_key("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"))
    return keyed.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"))


@query("F21_random_metric", "SELECT o_orderkey, CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS metric FROM orders")
def f21(spark, sf):
    """A made-up metric per parcel, repeatable: drawn from the key, not from row order."""
    u = F.conv(F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 8), 16, 10).cast("double") / 4294967296.0
    return table(spark, sf, "orders").select("o_orderkey", u.alias("metric"))


@query(
    "F22_winter_season",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season FROM (SELECT *, CASE WHEN month(l_shipdate) <= 2 THEN year(l_shipdate) - 1 ELSE year(l_shipdate) END AS y FROM lineitem WHERE month(l_shipdate) IN (1, 2, 11, 12))",
)
def f22(spark, sf):
    winter = table(spark, sf, "lineitem").where(F.month("l_shipdate").isin(1, 2, 11, 12))
    return winter.select("l_orderkey", "l_linenumber", "l_partkey", X.winter_season("l_shipdate").alias("season"))


# -- G: geometry columns -------------------------------------------------------------


def holed(spark, sf):
    """Parcels with a rectangular hole 8 m inside the outline."""
    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("w"), y0 + F.col("h")

    def ring(a, b, c, d):
        return F.array(G.vertex(a, b), G.vertex(a, d), G.vertex(c, d), G.vertex(c, b), G.vertex(a, b))

    rings = F.array(ring(x0, y0, x1, y1), ring(x0 + 8, y0 + 8, x1 - 8, y1 - 8))
    return layer(spark, sf, "parcels").withColumn("geometry", G.polygon(rings))


def zigzags(spark, sf):
    """Lines of three legs per customer: east, north, east."""
    x, y, w, h = (F.col(c) for c in ("x", "y", "w", "h"))
    base = layer(spark, sf, "hedges").select("k", F.col("x0").alias("x"), F.col("y0").alias("y"), (20 + F.col("k") % 70).alias("w"), (15 + F.col("k") % 50).alias("h"))
    ring = F.array(G.vertex(x, y), G.vertex(x + w, y), G.vertex(x + w, y + h), G.vertex(x + w + w, y + h))
    return base.withColumn("geometry", G.line(ring))


ZIGZAG_SQL = with_sql("hedges") + ", zig AS (SELECT k, x0 AS x, y0 AS y, 20 + k % 70 AS w, 15 + k % 50 AS h FROM hedges) "


@query("G1_area", with_sql("parcels") + "SELECT id_parcel, CAST(w * h - (w - 16) * (h - 16) AS DOUBLE) AS area, round((w * h - (w - 16) * (h - 16)) / 10000.0::DOUBLE, 6) AS area_ha FROM parcels")
def g1(spark, sf):
    return holed(spark, sf).select("id_parcel", G.area("geometry").alias("area"), F.round(G.area("geometry") / 10000, 6).alias("area_ha"))


@query("G1_area_diamond", with_sql("water") + "SELECT k, CAST(2 * w * w AS DOUBLE) AS area FROM water")
def g1_diamond(spark, sf):
    return layer(spark, sf, "water").select("k", G.area(G.diamond("x0", "y0", "w")).alias("area"))


@query("G2_length", ZIGZAG_SQL + "SELECT k, CAST(2 * w + h AS DOUBLE) AS m FROM zig")
def g2(spark, sf):
    return zigzags(spark, sf).select("k", G.length("geometry").alias("m"))


@query("G3_bounds", with_sql("parcels") + "SELECT id_business, min(x0)::DOUBLE AS xmin, min(y0)::DOUBLE AS ymin, max(x1)::DOUBLE AS xmax, max(y1)::DOUBLE AS ymax FROM parcels GROUP BY GROUPING SETS ((id_business), ())")
def g3(spark, sf):
    g = layer(spark, sf, "parcels").select("id_business", "geometry.*")
    aggs = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    return g.rollup("id_business").agg(*aggs)


@query("G4_centroid", with_sql("parcels") + "SELECT id_parcel, round(x0 + w / 2.0, 6)::DOUBLE AS x, round(y0 + h / 2.0, 6)::DOUBLE AS y FROM parcels")
def g4(spark, sf):
    c = G.centroid("geometry")
    return holed(spark, sf).select("id_parcel", F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@query("G4_centroid_line", ZIGZAG_SQL + "SELECT k, round((w * (x + w / 2.0) + h * (x + w) + w * (x + 1.5 * w)) / (2 * w + h), 6)::DOUBLE AS x, round((w * y + h * (y + h / 2.0) + w * (y + h)) / (2 * w + h), 6)::DOUBLE AS y FROM zig")
def g4_line(spark, sf):
    c = G.centroid("geometry")
    return zigzags(spark, sf).select("k", F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@query("G5_boundary", with_sql("parcels") + "SELECT id_parcel, CAST(2 AS INT) AS n_rings, CAST(2 * (w + h) + 2 * (w - 16 + h - 16) AS DOUBLE) AS m FROM parcels")
def g5(spark, sf):
    b = holed(spark, sf).select("id_parcel", G.boundary("geometry").alias("b"))
    return b.select("id_parcel", F.size("b.parts").alias("n_rings"), G.length("b").alias("m"))


@query("G6_dump_parts", with_sql("parcels") + "SELECT id_business, CAST(w * h AS DOUBLE) AS area FROM parcels")
def g6(spark, sf):
    multi = layer(spark, sf, "parcels").groupBy("id_business").agg(G.collect_multipart("geometry").alias("geometry"))
    return linear.dump_parts(multi).select("id_business", G.area("geometry").alias("area"))


@query(
    "G7_dump_points",
    with_sql("parcels") + "SELECT id_parcel, CAST(n AS INT) AS pos, CAST(CASE WHEN n IN (2, 3) THEN x1 ELSE x0 END AS DOUBLE) AS x, CAST(CASE WHEN n IN (1, 2) THEN y1 ELSE y0 END AS DOUBLE) AS y FROM parcels, range(5) t(n)",
)
def g7(spark, sf):
    return linear.dump_points(layer(spark, sf, "parcels").select("id_parcel", "geometry")).select("id_parcel", "pos", "x", "y")


@query(
    "G8_lead_segments",
    ZIGZAG_SQL + "SELECT k, CAST(n AS INT) AS pos, CAST(CASE n WHEN 1 THEN h ELSE w END AS DOUBLE) AS m FROM zig, range(3) t(n)",
)
def g8(spark, sf):
    pts = linear.dump_points(zigzags(spark, sf).select("k", "geometry"))
    e = linear.lead_edges(pts, ["k", "part", "ring"])
    return e.select("k", "pos", F.sqrt(F.pow(F.col("x1") - F.col("x0"), 2) + F.pow(F.col("y1") - F.col("y0"), 2)).alias("m"))


@query(
    "W7_lead_pairs",
    ZIGZAG_SQL
    + """SELECT k, CAST(n AS INT) AS pos, CAST(x + CASE WHEN n > 0 THEN w ELSE 0 END AS DOUBLE) AS x0, CAST(y + CASE WHEN n = 2 THEN h ELSE 0 END AS DOUBLE) AS y0,
        CAST(x + CASE WHEN n = 2 THEN 2 * w ELSE w END AS DOUBLE) AS x1, CAST(y + CASE WHEN n > 0 THEN h ELSE 0 END AS DOUBLE) AS y1 FROM zig, range(3) t(n)""",
)
def w7(spark, sf):
    pairs = linear.lead_edges(linear.dump_points(zigzags(spark, sf).select("k", "geometry")), ["k", "part", "ring"])
    return pairs.select("k", "pos", "x0", "y0", "x1", "y1")


def mixed(spark, sf):
    """One collection per business: its parcels, a point at each parcel's corner, and a line."""
    p = layer(spark, sf, "parcels")
    x0, y0, x1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w")
    parts = F.concat(F.col("geometry.parts"), G.point(x0, y0)["parts"], G.segment(x0, y0, x1, y0)["parts"])
    return p.withColumn("geometry", G.from_parts(parts))


@query("G9_extract_type", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS area, CAST(w AS DOUBLE) AS m, 'Point' AS kind FROM parcels")
def g9(spark, sf):
    g = mixed(spark, sf)
    return g.select(
        "id_parcel", G.area(G.extract("geometry", 2)).alias("area"), G.length(G.extract("geometry", 1)).alias("m"), G.geometry_type(G.extract("geometry", 0)).alias("kind")
    )


@query(
    "G10_geometry_census",
    "WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM events) AS e, (SELECT count(*) FROM customer) AS c)"
    " SELECT 'Polygon' AS type, o AS n, 5.0::DOUBLE AS mean_vertices FROM n UNION ALL SELECT 'Point', e, 1.0 FROM n UNION ALL SELECT 'LineString', c, 2.0 FROM n UNION ALL SELECT 'GeometryCollection', o, 8.0 FROM n",
)
def g10(spark, sf):
    layers = [layer(spark, sf, n).select("geometry") for n in ("parcels", "trees", "hedges")] + [mixed(spark, sf).select("geometry")]
    every = layers[0].unionAll(layers[1]).unionAll(layers[2]).unionAll(layers[3])
    return reference_grid.census(every)


@query("G11_clean", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS area, 5 AS n_vertices FROM parcels")
def g11(spark, sf):
    """Outlines with a spurious vertex on every side and coordinates off the 1 m grid."""
    x0, y0 = F.col("x0") + F.lit(0.2), F.col("y0") - F.lit(0.3)
    x1, y1 = x0 + F.col("w"), y0 + F.col("h")
    xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
    ring = F.array(
        G.vertex(x0, y0), G.vertex(x0 + 0.1, ym), G.vertex(x0, y1), G.vertex(xm, y1 + 0.1), G.vertex(x1, y1), G.vertex(x1 - 0.1, ym), G.vertex(x1, y0), G.vertex(xm, y0 - 0.1), G.vertex(x0, y0)
    )
    g = spread(layer(spark, sf, "parcels")).withColumn("geometry", S.clean(G.polygon(F.array(ring))))
    return g.select("id_parcel", G.area("geometry").alias("area"), G.vertex_count("geometry").alias("n_vertices"))


@query("G12_simplify", ZIGZAG_SQL + "SELECT k, 4 AS n, CAST(2 * w + h AS DOUBLE) AS m FROM zig")
def g12(spark, sf):
    """Lines with a slight bend inside each leg lose it again."""
    x, y, w, h = (F.col(c) for c in ("x", "y", "w", "h"))
    ring = F.array(
        G.vertex(x, y), G.vertex(x + w / 2, y + 0.5), G.vertex(x + w, y), G.vertex(x + w + 0.4, y + h / 2), G.vertex(x + w, y + h), G.vertex(x + w * 1.5, y + h - 0.5), G.vertex(x + w * 2, y + h)
    )
    g = spread(zigzags(spark, sf)).withColumn("geometry", S.simplify(G.line(ring), 1.0))
    return g.select("k", G.vertex_count("geometry").alias("n"), G.length("geometry").alias("m"))


@query("G13_snap", with_sql("parcels") + "SELECT id_parcel, CAST(floor(x0 / 5.0 + 0.5) * 5 AS DOUBLE) AS xmin, CAST(floor(y1 / 5.0 + 0.5) * 5 AS DOUBLE) AS ymax FROM parcels")
def g13(spark, sf):
    g = layer(spark, sf, "parcels").select("id_parcel", G.snap("geometry", 5.0).alias("g"))
    return g.select("id_parcel", "g.xmin", "g.ymax")


@query(
    "G14_validity_census",
    "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN o_orderkey % 11 IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid, CAST(sum(CASE WHEN o_orderkey % 11 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty, CAST(sum(CASE WHEN o_orderkey % 11 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM orders",
)
def g14(spark, sf):
    """Some outlines left open, some flattened to zero area, some empty, some missing."""
    p = layer(spark, sf, "parcels")
    r = F.col("geometry.parts")[0]["rings"][0]
    opened = G.polygon(F.array(F.slice(r, 1, 4)))
    flat = G.polygon(F.array(F.transform(r, lambda v: F.struct(v["x"].alias("x"), F.lit(0.0).alias("y")))))
    k = F.col("k") % 11
    g = F.when(k == 0, opened).when(k == 1, flat).when(k == 2, G.empty()).when(k != 3, F.col("geometry"))
    return reference_grid.validity(p.withColumn("geometry", g))


@query(
    "G15_segmentise_tolerance",
    ZIGZAG_SQL + "SELECT k, CAST(CASE WHEN true THEN ceil(w / 50.0) + ceil(h / 50.0) + ceil(w / 50.0) END AS BIGINT) AS n, CAST(2 * w + h AS DOUBLE) AS m FROM zig",
)
def g15(spark, sf):
    cut = spread(zigzags(spark, sf)).select("k", F.explode(S.segmentise("geometry", 5.0, 50.0)).alias("geometry"))
    return cut.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum(G.length("geometry")), 6).alias("m"))


@query("G16_equal_chords", with_sql("hedges") + "SELECT k, CAST(ceil((w + h) / 10.0) AS BIGINT) AS n, round((w + h) / ceil((w + h) / 10.0), 6)::DOUBLE AS longest FROM hedges")
def g16(spark, sf):
    cut = layer(spark, sf, "hedges").select("k", F.explode(S.chords("geometry", 10.0)).alias("geometry"))
    return cut.groupBy("k").agg(F.count("*").alias("n"), F.round(F.max(G.length("geometry")), 6).alias("longest"))


LETTERS = "'ABCDEFGHJKLMNOPQRSTUVWXYZ'"
NAME_SQL = (
    f"substr({LETTERS}, CAST((19 - n) - (19 - n) % 5 + (e + 10) // 5 + 1 AS INT), 1) || substr({LETTERS}, CAST(((19 - n) * 5) % 25 + e % 5 + 1 AS INT), 1)"
)


@query(
    "G17_grid_names",
    f"SELECT o_orderkey, nm || lpad(CAST((x // 1000) % 100 AS VARCHAR), 2, '0') || lpad(CAST((y // 1000) % 100 AS VARCHAR), 2, '0') AS km1, nm || CAST((x // 10000) % 10 AS VARCHAR) || CAST((y // 10000) % 10 AS VARCHAR) AS km10, nm AS km100"
    f" FROM (SELECT *, {NAME_SQL} AS nm FROM (SELECT *, x // 100000 AS e, y // 100000 AS n FROM (SELECT o_orderkey, (o_orderkey * 7919) % 700000 AS x, (o_orderkey * 104729) % 1300000 AS y FROM orders)))",
)
def g17(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "(o_orderkey * 7919) % 700000 AS x", "(o_orderkey * 104729) % 1300000 AS y")
    named = o.select("o_orderkey", G.national_grid_name("x", "y", 2).alias("km1"), G.national_grid_name("x", "y", 1).alias("by_xy"), G.national_grid_name("x", "y", 0).alias("km100"))
    parsed = X.parcel_grid_names(F.concat("km1", F.lit("0000")))
    return named.select("o_orderkey", parsed["tile_1km"].alias("km1"), parsed["tile_10km"].alias("km10"), "km100")


@query(
    "G18_grid_resolution",
    "SELECT name, target, CASE WHEN 91 > n // target THEN 100000 WHEN 9100 > n // target THEN 10000 ELSE 1000 END AS resolution FROM (SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem), (VALUES (1000), (100), (10)) t(target)",
)
def g18(spark, sf):
    counts = table(spark, sf, "orders").agg(F.count("*").alias("n")).select(F.lit("orders").alias("name"), "n")
    counts = counts.unionAll(table(spark, sf, "lineitem").agg(F.count("*").alias("n")).select(F.lit("lineitem"), "n"))
    rows = counts.select("name", "n", F.explode(F.array(F.lit(1000), F.lit(100), F.lit(10))).alias("target"))
    return rows.select("name", "target", reference_grid.resolution("n", "target").alias("resolution"))


@query("G19_subdivide", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS area, 41 AS before, true AS small FROM parcels")
def g19(spark, sf):
    """Outlines of 41 vertices cut into pieces of at most 12; the area stays."""
    x0, y0, w, h = (F.col(c).cast("double") for c in ("x0", "y0", "w", "h"))

    def side(ax, ay, dx, dy):
        return F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct((ax + dx * i / 10).alias("x"), (ay + dy * i / 10).alias("y")))

    none = F.lit(0.0)
    ring = F.concat(side(x0, y0, none, h), side(x0, y0 + h, w, none), side(x0 + w, y0 + h, none, -h), side(x0 + w, y0, -w, none), F.array(G.vertex(x0, y0)))
    g = spread(layer(spark, sf, "parcels")).select("id_parcel", G.polygon(F.array(ring)).alias("g"))
    pieces = g.select("id_parcel", G.vertex_count("g").alias("before"), F.explode(S.subdivide("g", 12)).alias("p"))
    return pieces.groupBy("id_parcel", "before").agg(F.round(F.sum(G.area("p")), 6).alias("area"), (F.max(G.vertex_count("p")) <= 12).alias("small"))


@query("G19_fishnet", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS area, ((x1 - 1) // 50 - x0 // 50 + 1) * ((y1 - 1) // 50 - y0 // 50 + 1) AS n FROM parcels")
def g19_fishnet(spark, sf):
    cut = spread(layer(spark, sf, "parcels")).select("id_parcel", F.explode(S.fishnet("geometry", 50.0)).alias("p"))
    return cut.groupBy("id_parcel").agg(F.round(F.sum(G.area("p")), 6).alias("area"), F.count("*").alias("n"))


@query("G20_lonlat")
def g20(spark, sf):
    """Longitude and latitude of parcel centroids, axes flipped and restored."""
    p = spread(layer(spark, sf, "parcels")).withColumn("c", G.centroid(G.flip(G.flip("geometry"))))
    ll = p.select("id_parcel", S.lonlat(F.col("c.x") + 300000, F.col("c.y") + 200000).alias("ll"))
    return ll.select("id_parcel", F.round("ll.x", 5).alias("lon"), F.round("ll.y", 5).alias("lat"))


@query(
    "G21_text_forms",
    with_sql("parcels")
    + """SELECT id_parcel, format('POLYGON (({0} {1}, {0} {3}, {2} {3}, {2} {1}, {0} {1}))', x0, y0, x1, y1) AS wkt,
        '{"type":"Polygon","coordinates":[[' || format('[{0},{1}],[{0},{3}],[{2},{3}],[{2},{1}],[{0},{1}]', x0, y0, x1, y1) || ']]}' AS geojson FROM parcels""",
)
def g21(spark, sf):
    return layer(spark, sf, "parcels").select("id_parcel", C.to_wkt("geometry").alias("wkt"), C.to_geojson("geometry").alias("geojson"))


@query("G21_feature_collections", with_sql("parcels") + "SELECT (x0 // 1000) * 1000 AS tile_x, (y0 // 1000) * 1000 AS tile_y, count(*) AS n_features FROM parcels GROUP BY ALL")
def g21_collections(spark, sf):
    """One GeoJSON FeatureCollection per tile (a tile holds a bounded number of parcels)."""
    p = layer(spark, sf, "parcels")
    tx, ty = G.grid_tile("x0", "y0", 1000)
    feature = F.concat(F.lit('{"type":"Feature","properties":{"id":"'), F.col("id_parcel"), F.lit('"},"geometry":'), C.to_geojson("geometry"), F.lit("}"))
    docs = p.groupBy(tx.alias("tile_x"), ty.alias("tile_y")).agg(F.collect_list(feature).alias("features"))
    doc = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("features", ","), F.lit("]}"))
    return docs.select("tile_x", "tile_y", F.json_array_length(F.get_json_object(doc, "$.features")).cast("long").alias("n_features"))


@query("G22_apply_function", with_sql("parcels") + "SELECT id_parcel, CAST(w * h * 4 AS DOUBLE) AS area FROM parcels")
def g22(spark, sf):
    """An arbitrary function per geometry: doubled about the origin."""
    g = S.apply_parts("geometry", lambda parts: [(d, [r * 2 for r in rings]) for d, rings in parts])
    return layer(spark, sf, "parcels").select("id_parcel", G.area(g).alias("area"))


@query("G23_empty_default", "SELECT c_custkey, CASE WHEN o IS NULL THEN 'Empty' ELSE 'Polygon' END AS kind FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS o FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey")
def g23(spark, sf):
    p = table(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("k"))
    shapes = p.join(layer(spark, sf, "parcels").select("k", "geometry"), "k")
    c = table(spark, sf, "customer").join(shapes, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select("c_custkey", G.geometry_type(G.or_empty("geometry")).alias("kind"))


@query(
    "G24_pointify",
    with_sql("water") + "SELECT k, CAST(gx * 10 + 5 AS DOUBLE) AS x, CAST(gy * 10 + 5 AS DOUBLE) AS y FROM (SELECT *, unnest(range((x0 - w) // 10 - 1, (x0 + w) // 10 + 1)) AS gx FROM water) q, LATERAL (SELECT unnest(range((q.y0 - q.w) // 10 - 1, (q.y0 + q.w) // 10 + 1)) AS gy) WHERE abs(gx * 10 + 5 - x0) + abs(gy * 10 + 5 - y0) < w OR (abs(gx * 10 + 5 - x0) + abs(gy * 10 + 5 - y0) = w AND gx * 10 + 5 < x0)",
)
def g24(spark, sf):
    """Cell centres in each diamond; of those on its outline, the ones on the left sides."""
    zones = layer(spark, sf, "water").select("k", G.diamond("x0", "y0", "w").alias("g"))
    dots = cells(zones, 10.0, geometry="g")
    return dots.select("k", ((F.col("col") + 0.5) * 10).alias("x"), ((F.col("row") + 0.5) * 10).alias("y"))


@query(
    "G25_hex_cells",
    with_sql("trees")
    + """SELECT q, r, count(*) AS n FROM (SELECT CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END::BIGINT AS q, CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END::BIGINT AS r FROM (
        SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM (SELECT q, r, -q - r AS s, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM (
        SELECT (x0::DOUBLE * sqrt(3.0) / 3 - y0::DOUBLE / 3) / 300 AS q, (y0::DOUBLE * 2 / 3) / 300 AS r FROM trees)))) GROUP BY ALL""",
)
def g25(spark, sf):
    q, r = G.hex_cell("x0", "y0", 300.0)
    return layer(spark, sf, "trees").groupBy(q.alias("q"), r.alias("r")).agg(F.count("*").alias("n"))
