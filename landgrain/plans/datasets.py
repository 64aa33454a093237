"""Source, sink, catalogue, rule and function-surface queries."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.functions import shapes as S
from landgrain.functions.kernels import PartsReader, parts_area
from landgrain.operators import linear, overlap, tables as T
from landgrain.plans.book import query
from landgrain.plans.fixtures import CELL, layer, table, with_sql
from landgrain.sources import catalogue, readers, rules, writers


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder, or a temporary one on a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        import tempfile

        base = tempfile.gettempdir()
    return os.path.join(base, f"landgrain-{uuid.uuid4().hex}")


# -- S: sources and sinks ----------------------------------------------------------------


@query("S1_geoparquet_scan", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS area FROM parcels")
def s1(spark, sf):
    path = scratch(spark)
    writers.write_parquet(layer(spark, sf, "parcels").select("id_parcel", "geometry"), path)
    return readers.read_parquet(spark, path).select("id_parcel", G.area("geometry").alias("area"))


@query("S2_schema_drift", "SELECT o_orderkey AS k, CAST(o_custkey AS BIGINT) AS v, NULL::VARCHAR AS extra FROM orders UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def s2(spark, sf):
    a, b = scratch(spark), scratch(spark)
    table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")).write.parquet(a)
    table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("int").alias("v"), F.col("c_mktsegment").alias("extra")).write.parquet(b)
    return readers.read_drifting(spark, [a, b])


@query("S3_csv_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s3(spark, sf):
    path = scratch(spark)
    writers.export(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path, "csv")
    return readers.read_csv(spark, path, "s_suppkey long, s_name string, s_acctbal double")


@query("S4_glob_provenance", "SELECT p_type AS origin, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS s FROM part GROUP BY 1")
def s4(spark, sf):
    path = scratch(spark)
    writers.write_parquet(table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("origin")), path, ["origin"])
    df = readers.read_glob(spark, f"{path}/*/*.parquet")
    return df.groupBy(F.regexp_extract("_path", "origin=([^/]+)/", 1).alias("origin")).agg(F.count("*").alias("n"), F.sum("p_partkey").alias("s"))


@query("S5_path_columns", "SELECT p_partkey, p_type AS woodland_type, lpad(CAST(p_size AS VARCHAR), 2, '0') AS rcp FROM part")
def s5(spark, sf):
    path = F.concat(F.lit("/raw/panel/"), F.col("p_type"), F.lit("/output_rcp"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(".csv"))
    df = table(spark, sf, "part").withColumn("_path", path)
    cols = readers.path_columns("_path")
    return df.select("p_partkey", *[c.alias(n) for n, c in cols.items()])


@query("S6_projected_read", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_quantity > 30")
def s6(spark, sf):
    return readers.read_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_quantity"], where="l_shipdate < TIMESTAMP '1996-01-01' AND l_quantity > 30")


@query("S7_layers", "SELECT 'suppliers' AS layer, s_suppkey AS k FROM supplier UNION ALL SELECT 'customers', c_custkey FROM customer")
def s7(spark, sf):
    df = readers.read_layers(spark, {"suppliers": f"{sf}/supplier.parquet", "customers": f"{sf}/customer.parquet"})
    return df.select("layer", F.coalesce("s_suppkey", "c_custkey").alias("k"))


@query("S8_text_and_binary_forms", with_sql("parcels") + "SELECT id_parcel, CAST(w * h AS DOUBLE) AS from_wkt, CAST(w * h AS DOUBLE) AS from_wkb, CAST(w * h AS DOUBLE) AS from_geojson FROM parcels")
def s8(spark, sf):
    p = layer(spark, sf, "parcels").select("id_parcel", C.to_wkt("geometry").alias("t"), C.to_wkb("geometry").alias("b"), C.to_geojson("geometry").alias("j"))
    return p.select("id_parcel", G.area(C.from_wkt("t")).alias("from_wkt"), G.area(C.from_wkb("b")).alias("from_wkb"), G.area(C.from_geojson("j")).alias("from_geojson"))


@query("S9_replace_sink", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s9(spark, sf):
    path = scratch(spark)
    writers.write_parquet(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    writers.write_parquet(table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("S10_partitioned_sink", "SELECT l_returnflag AS class, CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'a metric' END AS desc, count(*) AS n FROM lineitem GROUP BY 1, 2")
def s10(spark, sf):
    path = scratch(spark)
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("class"), F.when(F.col("l_returnflag") != "A", "a metric").alias("desc"))
    writers.write_parquet(rows, path, ["class"])
    return spark.read.parquet(path).groupBy("class", "desc").agg(F.count("*").alias("n"))


@query("S11_batched_sink", "SELECT o_orderstatus, b AS batch, count(*) AS n FROM (SELECT o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) // 500 AS INT) AS b FROM orders) GROUP BY ALL")
def s11(spark, sf):
    path = scratch(spark)
    writers.write_batches(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"], "o_orderkey", "o_orderkey")
    return spark.read.parquet(path).groupBy("o_orderstatus", "batch").agg(F.count("*").alias("n"))


@query("S12_export_single", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s12(spark, sf):
    path = scratch(spark)
    writers.export(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "json")
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").json(path)


@query("S13_export_split", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def s13(spark, sf):
    path = scratch(spark)
    writers.export_split(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"), path, ["l_returnflag", "l_linestatus"])
    return spark.read.option("header", True).csv(path).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


# -- D: catalogue and rules ------------------------------------------------------------------

# A dependency tree over the parts: every part is built from the part with half its key.
TREE_SQL = "edges AS (SELECT CAST(p_partkey AS VARCHAR) AS name, CAST(p_partkey // 2 AS VARCHAR) AS parent FROM part WHERE p_partkey > 0)"


def tree(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("name"), F.floor(F.col("p_partkey") / 2).cast("string").alias("parent"))
    return p.select("name"), p.where("name != '0'").select("name", "parent", F.lit(0).alias("pos"))


@query("D2_lineage", f"WITH RECURSIVE {TREE_SQL}, walk(name, ancestor, depth) AS (SELECT name, parent, 1 FROM edges UNION ALL SELECT w.name, e.parent, w.depth + 1 FROM walk w JOIN edges e ON w.ancestor = e.name) SELECT * FROM walk")
def d2(spark, sf):
    return catalogue.lineage(tree(spark, sf)[1])


@query("D2_build_levels", "SELECT CAST(p_partkey AS VARCHAR) AS name, CAST(CASE WHEN p_partkey = 0 THEN 0 ELSE length(bin(p_partkey)) END AS INT) AS level FROM part")
def d2_levels(spark, sf):
    names, edges = tree(spark, sf)
    return catalogue.build_levels(names, edges)


@query(
    "D2_impact",
    f"WITH RECURSIVE {TREE_SQL}, walk(name, ancestor) AS (SELECT name, parent FROM edges UNION ALL SELECT w.name, e.parent FROM walk w JOIN edges e ON w.ancestor = e.name) SELECT ancestor, count(*) AS n_downstream FROM walk GROUP BY 1",
)
def d2_impact(spark, sf):
    return catalogue.impact(tree(spark, sf)[1])


REGISTRY_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 3 = 0 THEN 'source' ELSE 'derived' END AS kind, 'level' || CAST(p_partkey % 4 AS VARCHAR) AS level, p_partkey % 5 = 0 AS restricted, CASE WHEN p_partkey > 0 THEN 1 ELSE 0 END AS n FROM part"


def registry(spark, sf):
    """One dataset per part, which depends on the part with half its key."""
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        k.cast("string").alias("name"),
        F.when(k % 3 == 0, "source").otherwise("derived").alias("kind"),
        F.concat(F.lit("level"), (k % 4).cast("string")).alias("level"),
        (k % 5 == 0).alias("restricted"),
        F.when(k > 0, F.array(F.floor(k / 2).cast("string"))).otherwise(F.array().cast("array<string>")).alias("depends"),
    )


@query("D1_summary", f"SELECT kind, level, count(*) AS n, count(*) FILTER (restricted) AS n_restricted, sum(n)::BIGINT AS n_depends FROM ({REGISTRY_SQL}) GROUP BY ALL")
def d1(spark, sf):
    return catalogue.summary(registry(spark, sf))


@query("D1_select", f"SELECT name, level FROM ({REGISTRY_SQL}) WHERE kind = 'source' AND restricted")
def d1_select(spark, sf):
    return catalogue.select_datasets(registry(spark, sf), kind="source", restricted=True).select("name", "level")


LISTING = "SELECT concat('/lake/', 'set_', CAST(o_custkey AS varchar(20)), '-', {day}, '-', left({sha}, 8), '.parquet') AS path, o_orderdate AS modified FROM orders"
LISTING_SQL = LISTING.format(day="strftime(o_orderdate, '%Y_%m_%d')", sha="sha256(CAST(o_orderkey % 3 AS VARCHAR))")


@query(
    "D3_freshness",
    f"""WITH listing AS (SELECT path, regexp_extract(path, '([^/]+)-(\\d{{4}}_\\d{{2}}_\\d{{2}})-', 1) AS name, regexp_extract(path, '-(\\d{{4}}_\\d{{2}}_\\d{{2}})-', 1) AS date, left(right(path, 16), 8) AS hash FROM (SELECT DISTINCT path FROM ({LISTING_SQL}))),
    want AS (SELECT 'set_' || CAST(c_custkey AS VARCHAR) AS name, left(sha256('1'), 8) AS hash FROM customer),
    newest AS (SELECT name, date, hash AS found FROM listing QUALIFY row_number() OVER (PARTITION BY name ORDER BY date DESC, hash) = 1)
    SELECT w.name, w.hash, n.date, w.name IN (SELECT l.name FROM listing l JOIN want v ON l.name = v.name AND l.hash = v.hash) AS is_fresh FROM want w LEFT JOIN newest n USING (name)""",
)
def d3(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    text = LISTING.format(day="date_format(o_orderdate, 'yyyy_MM_dd')", sha="sha2(CAST(o_orderkey % 3 AS string), 256)").replace("varchar(20)", "string")
    listing = spark.sql(text).select("path", F.col("modified").alias("modificationTime"), F.lit(1).cast("long").alias("length"))
    want = table(spark, sf, "customer").select(F.concat(F.lit("set_"), F.col("c_custkey").cast("string")).alias("name"), F.left(F.sha2(F.lit("1"), 256), F.lit(8)).alias("hash"))
    return catalogue.freshness(catalogue.newest_files(listing), want).select("name", "hash", "date", "is_fresh")


@query(
    "D4_version_hashes",
    f"WITH RECURSIVE {TREE_SQL}, h(name, hash) AS (SELECT '0', left(sha256('root'), 8) UNION ALL SELECT e.name, left(sha256(h.hash), 8) FROM h JOIN edges e ON e.parent = h.name) SELECT * FROM h",
)
def d4(spark, sf):
    names, edges = tree(spark, sf)
    known = names.where("name = '0'").select("name", F.substring(F.sha2(F.lit("root"), 256), 1, 8).alias("hash"))
    return catalogue.derive_hashes(known, names.withColumn("version", F.lit("")), edges, catalogue.build_levels(names, edges))


PARCEL_MODEL = rules.Model(
    columns={
        "id_parcel": rules.Rule("string", nullable=False, unique=True, matches=r"^[A-Z]{2}\d{8}$"),
        "sbi": rules.Rule("string", matches=r"^\d{9}$"),
        "area_ha": rules.Rule("double", nullable=False, gt=0, le=0.8),
        "kind": rules.Rule("string", isin=("P", "F")),
    },
    invariants={"large parcels are filled": "area_ha < 0.5 OR kind = 'F'"},
)
MESSY = "CASE WHEN k % 50 = 0 THEN concat('x', id_parcel) ELSE id_parcel END AS id_parcel, CASE WHEN k % 3 = 0 THEN NULL WHEN k % 7 = 0 THEN '12' ELSE lpad(CAST(k AS {s}), 9, '1') END AS sbi, w * h / 10000.0 AS area_ha, o_orderstatus AS kind"


@query(
    "D6_validation_report",
    with_sql("parcels")
    + f""", messy AS (SELECT {MESSY.format(s='VARCHAR')} FROM parcels JOIN orders ON k = o_orderkey)
    SELECT * FROM (SELECT 'id_parcel' AS "column", 'not_null' AS rule, count(*) FILTER (id_parcel IS NULL) AS failures FROM messy UNION ALL SELECT 'id_parcel', 'matches', count(*) FILTER (NOT regexp_matches(id_parcel, '^[A-Z]{{2}}\\d{{8}}$')) FROM messy
        UNION ALL SELECT 'sbi', 'matches', count(*) FILTER (NOT regexp_matches(sbi, '^\\d{{9}}$')) FROM messy UNION ALL SELECT 'area_ha', 'not_null', count(*) FILTER (area_ha IS NULL) FROM messy
        UNION ALL SELECT 'area_ha', 'gt', count(*) FILTER (area_ha <= 0) FROM messy UNION ALL SELECT 'area_ha', 'le', count(*) FILTER (area_ha > 0.8) FROM messy UNION ALL SELECT 'kind', 'isin', count(*) FILTER (kind NOT IN ('P', 'F')) FROM messy
        UNION ALL SELECT '*', 'large parcels are filled', count(*) FILTER (NOT (area_ha < 0.5 OR kind = 'F')) FROM messy
        UNION ALL SELECT 'id_parcel', 'unique', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM messy GROUP BY id_parcel HAVING count(*) > 1))""",
)
def d6(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    messy = layer(spark, sf, "parcels").join(o, "k").selectExpr(*[e for e in _split(MESSY.format(s="string"))]).withColumn("area_ha", F.col("area_ha").cast("double"))
    return rules.validate(messy, PARCEL_MODEL)


def _split(exprs: str) -> list[str]:
    """Split a select list at commas outside brackets."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(exprs):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(exprs[start:i])
            start = i + 1
    return out + [exprs[start:]]


# -- U: function surfaces ------------------------------------------------------------------------


@query("U1_scalar_geometry_function", with_sql("parcels") + "SELECT id_parcel, CAST((w + 2) * (h + 2) AS DOUBLE) AS area FROM parcels")
def u1(spark, sf):
    def grow(parts):
        out = []
        for dim, rings in parts:
            mid = (rings[0].min(axis=0) + rings[0].max(axis=0)) / 2
            out.append((dim, [r + (r > mid) * 1.0 - (r < mid) * 1.0 for r in rings]))
        return out

    return layer(spark, sf, "parcels").select("id_parcel", G.area(S.apply_parts("geometry", grow)).alias("area"))


@F.arrow_udf(returnType=ST.DoubleType())
def _areas_with_setup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    scale = sum(1.0 for _ in range(10_000)) / 10_000 / 10_000  # paid once per task
    for batch in batches:
        rows = PartsReader(batch)
        yield pa.array([parts_area(rows.parts(i)) * scale for i in range(len(rows))])


@query("U2_iterator_function", with_sql("parcels") + "SELECT id_parcel, round(w * h / 10000.0::DOUBLE, 6) AS ha FROM parcels")
def u2(spark, sf):
    return layer(spark, sf, "parcels").select("id_parcel", F.round(_areas_with_setup("geometry.parts"), 6).alias("ha"))


@query("U3_array_function", with_sql("hedges") + "SELECT k, CAST(ceil((w + h) / 25.0) AS INT) AS n FROM hedges")
def u3(spark, sf):
    return layer(spark, sf, "hedges").select("k", F.size(S.chords("geometry", 25.0)).alias("n"))


@query("U4_grouped_geometry_function", with_sql("hedges") + "SELECT kind, k // 100 AS band, CAST(sum(w + h) AS DOUBLE) AS m, count(*) AS n FROM hedges GROUP BY ALL")
def u4(spark, sf):
    """A grouped pandas function over bounded groups (a hundred lines each at most)."""

    def per_group(pdf):
        return pdf.groupby(["kind", "band"], as_index=False).agg(m=("m", "sum"), n=("m", "size"))

    lines = layer(spark, sf, "hedges").select("kind", F.floor(F.col("k") / 100).alias("band"), G.length("geometry").alias("m"))
    return lines.groupBy("kind", "band").applyInPandas(per_group, "kind string, band long, m double, n long")


@query("U5_batch_table_function", "SELECT event_id, 'user' AS key, CAST(user_id AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events")
def u5(spark, sf):
    def spread(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.concat([
                pd.DataFrame({"event_id": pdf["event_id"], "key": "user", "value": pdf["user_id"].astype(str)}),
                pd.DataFrame({"event_id": pdf["event_id"], "key": "type", "value": pdf["event_type"]}),
            ])

    return table(spark, sf, "events").select("event_id", "user_id", "event_type").mapInPandas(spread, "event_id long, key string, value string")


@query("U7_generators", with_sql("parcels") + "SELECT id_parcel, CAST(n AS INT) AS part, CAST(w * h AS DOUBLE) AS area FROM parcels, range(2) t(n)")
def u7(spark, sf):
    p = layer(spark, sf, "parcels")
    twin = G.from_parts(F.concat("geometry.parts", G.translate("geometry", 1000, 0)["parts"]))
    return linear.dump_parts(p.select("id_parcel", twin.alias("geometry"))).select("id_parcel", "part", G.area("geometry").alias("area"))


@query(
    "U7_table_function",
    with_sql("parcels") + "SELECT id_parcel AS id, 2::BIGINT AS n_pieces, 1 AS last_piece, round(CAST(4 * w * w AS DOUBLE), 6) AS area FROM parcels",
)
def u7_table(spark, sf):
    """Two diamonds of every parcel, numbered across its rows."""
    p = layer(spark, sf, "parcels").select("id_parcel", F.explode(F.array(F.lit(0), F.lit(1))).alias("n"), "x0", "y0", "w")
    shapes = p.select("id_parcel", "n", G.diamond(F.col("x0") + 1000 * F.col("n"), "y0", "w").alias("geometry"))
    out = linear.cut_pieces(shapes, "id_parcel", "n", 16)
    return out.groupBy("id").agg(F.count("*").alias("n_pieces"), F.max("piece").alias("last_piece"), F.round(F.sum("area"), 6).alias("area"))


@query("U8_hooks", with_sql("parcels", "features") + "SELECT id_parcel, count(*) > 0 AS covered FROM parcels p JOIN features f ON f.x0 < p.x1 AND f.x1 > p.x0 AND f.y0 < p.y1 AND f.y1 > p.y0 AND f.class = 'A' GROUP BY 1")
def u8(spark, sf):
    out = overlap.parcel_proportion(
        layer(spark, sf, "parcels"),
        layer(spark, sf, "features"),
        pre=lambda df: df.where("class = 'A'"),
        post=lambda df: df.where("proportion > 0").select("id_parcel", F.lit(True).alias("covered")),
        grid=CELL,
    )
    return out


# -- a lake of three datasets over the orders ------------------------------------------------


def lake(spark, sf, first: str = "true"):
    """A catalogue whose source holds the orders that `first` selects; returns it with the source's path."""
    src = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    orders.where(first).write.parquet(src)
    by_status = lambda df: df.groupBy("status").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))
    model = rules.Model({"key": rules.Rule("bigint", nullable=False, unique=True, alias="o_orderkey"), "status": rules.Rule("string", alias="o_orderstatus")})
    made = [
        catalogue.Dataset("raw", kind="source", level="bronze", path=src, model=model),
        catalogue.Dataset("totals", depends=("raw",), build=by_status),
        catalogue.Dataset("closed", depends=("raw",), build=by_status, restricted=True),
    ]
    return catalogue.Catalogue(spark, scratch(spark), made), src, orders


@query("D5_refresh", "SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, 'raw totals closed,,raw totals closed' AS rebuilt FROM orders GROUP BY 1")
def d5(spark, sf):
    """The source grows between two refreshes; a refresh with nothing new rebuilds nothing."""
    cat, src, orders = lake(spark, sf, "o_orderstatus = 'F'")
    rebuilt = [cat.refresh("2024_01_01"), cat.refresh("2024_01_02")]
    orders.where("o_orderstatus <> 'F'").write.mode("append").parquet(src)
    rebuilt.append(cat.refresh("2024_01_03"))
    order = {"raw": 0, "totals": 1, "closed": 2}
    runs = ",".join(" ".join(sorted(r, key=order.get)) for r in rebuilt)
    return cat.read("totals").select("status", "n", "keys", F.lit(runs).alias("rebuilt"))


@query("S14_publish", "SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, 'totals,' AS published FROM orders GROUP BY 1")
def s14(spark, sf):
    """Open derived tables reach the target once; the restricted one never does."""
    cat, _, _ = lake(spark, sf)
    cat.refresh("2024_01_01")
    target = scratch(spark)
    published = ",".join(" ".join(cat.publish(target)) for _ in range(2))
    return spark.read.parquet(f"{target}/totals-latest.parquet").select("status", "n", "keys", F.lit(published).alias("published"))
