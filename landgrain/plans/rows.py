"""Relational queries: projections, equi-joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgrain.functions import text as X
from landgrain.operators import ranking, tables as T
from landgrain.operators.quantiles import with_quantiles
from landgrain.plans.book import query
from landgrain.plans.fixtures import layer, table, with_sql
from landgrain.sources import rules

# -- P: projections and filters -----------------------------------------------------


@query(
    "P1_model_rename",
    "SELECT c_custkey AS id_business, c_name AS name, c_nationkey AS _region, c_mktsegment AS region, c_acctbal FROM customer",
)
def p1(spark, sf):
    df = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "region")
    return T.rename_to_model(df, {"c_custkey": "id_business", "c_name": "name", "c_mktsegment": "region"})


@query(
    "P2_rename_clash",
    "SELECT a.n_nationkey, a.n_name AS name_left, b.r_name AS name_right FROM nation a JOIN region b ON a.n_regionkey = b.r_regionkey",
)
def p2(spark, sf):
    from landgrain.operators.spatial_join import suffix_clashes

    a = table(spark, sf, "nation").withColumnsRenamed({"n_name": "name", "n_regionkey": "key"})
    b = table(spark, sf, "region").withColumnsRenamed({"r_name": "name", "r_regionkey": "key"})
    a, b = suffix_clashes(a, b)
    return a.join(b, a.key_left == b.key_right).select("n_nationkey", "name_left", "name_right")


@query("P3_keep_rename", "SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus FROM orders")
def p3(spark, sf):
    return T.tidy_columns(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"], {"o_orderkey": "id", "o_totalprice": "price"})


@query("P4_star_except", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def p4(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("p4_lines")
    return spark.sql("SELECT * EXCEPT (l_tax, l_discount) FROM p4_lines")


P5 = "p_type IN ('SMALL', 'ECONOMY') AND p_name NOT LIKE '%ring' AND p_size BETWEEN 5 AND 40 AND p_brand IS NOT NULL AND (p_retailprice < 1000 OR p_brand NOT IN ('Brand#1', 'Brand#2'))"


@query("P5_row_filters", f"SELECT p_partkey, p_name, p_type, p_size FROM part WHERE {P5}")
def p5(spark, sf):
    return table(spark, sf, "part").where(P5).select("p_partkey", "p_name", "p_type", "p_size")


def _thresholds(metric, limits):
    return ", ".join(f"({limit} < {metric}) AS bool_{int(limit * 100)}" for limit in limits)


@query("P6_threshold_flags", f"SELECT l_orderkey, l_linenumber, {_thresholds('l_discount', [0.02, 0.05])} FROM lineitem")
def p6(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[(F.lit(v) < F.col("l_discount")).alias(f"bool_{int(v * 100)}") for v in (0.02, 0.05)])


# Invented area columns of a farm record for the queries below.
ARABLE = ["wheat", "barley", "peas", "potatoes", "beans"]
GRASSLAND = ["lowland", "moorland", "fenland"]
FARM_COLUMNS = [f"ha_{c}" for c in ARABLE + GRASSLAND]


def _farm_exprs():
    return [f"CASE WHEN (c_custkey + {i}) % 4 = 0 THEN NULL ELSE CAST((c_custkey * {i + 3}) % 50 AS DOUBLE) END AS {c}" for i, c in enumerate(FARM_COLUMNS)]


def farms(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey AS id_business", "c_mktsegment AS farm_type", *_farm_exprs())


FARMS_SQL = "farms AS (SELECT c_custkey AS id_business, c_mktsegment AS farm_type, " + ", ".join(_farm_exprs()) + " FROM customer)"


def _sum_sql(cols):
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


ARABLE_SQL, GRASS_SQL = _sum_sql([f"ha_{c}" for c in ARABLE]), _sum_sql([f"ha_{c}" for c in GRASSLAND])


@query("P7_sum_of_columns", f"WITH {FARMS_SQL} SELECT id_business, {ARABLE_SQL} AS ha_arable, {GRASS_SQL} AS ha_grassland FROM farms")
def p7(spark, sf):
    return farms(spark, sf).select(
        "id_business", T.sum_columns([f"ha_{c}" for c in ARABLE]).alias("ha_arable"), T.sum_columns([f"ha_{c}" for c in GRASSLAND]).alias("ha_grassland")
    )


RATES = "SELECT c_custkey, c_custkey % 7 AS ha_wheat, c_custkey % 5 AS ha_peas, c_custkey % 9 AS tph_wheat, c_custkey % 3 AS tph_peas, c_custkey % 11 AS gmph_wheat, c_custkey % 13 AS gmph_peas FROM customer"


@query(
    "P8_rate_times_area",
    f"SELECT c_custkey, ha_wheat, ha_peas, tph_wheat * ha_wheat AS t_wheat, tph_peas * ha_peas AS t_peas, gmph_wheat * ha_wheat AS gm_wheat, gmph_peas * ha_peas AS gm_peas FROM ({RATES})",
)
def p8(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer")
    return T.multiply_families(spark.sql(RATES), "ha_", {"tph_": "t_", "gmph_": "gm_"})


@query(
    "P9_family_flag",
    f"WITH {FARMS_SQL} SELECT id_business, is_arable, CASE WHEN is_arable THEN 'Arable' WHEN is_grass THEN 'Grassland' ELSE 'Other' END AS type FROM (SELECT id_business, {ARABLE_SQL} > 60 AS is_arable, {GRASS_SQL} > 0 AS is_grass FROM farms)",
)
def p9(spark, sf):
    f = farms(spark, sf)
    arable = T.sum_columns([f"ha_{c}" for c in ARABLE]) > 60
    grass = T.any_positive(f.select(*[f"ha_{c}" for c in GRASSLAND]), "ha_")
    return f.select("id_business", arable.alias("is_arable"), F.when(arable, "Arable").when(grass, "Grassland").otherwise("Other").alias("type"))


WATER_CASE = "CASE WHEN w < 30 AND h < 10 THEN 'ditch' WHEN h < 12 THEN 'watercourse' ELSE 'waterbody' END"


@query("P10_case_classes", with_sql("water") + f"SELECT k, {WATER_CASE} AS class FROM water")
def p10(spark, sf):
    return layer(spark, sf, "water").selectExpr("k", f"{WATER_CASE} AS class")


# Farm type codes.
FARM_TYPES = {0: "None", 1: "Cereals", 2: "General cropping", 3: "Horticulture", 4: "Specialist pigs", 5: "Specialist poultry", 6: "Dairy", 7: "LFA grazing livestock", 8: "Lowland grazing livestock", 9: "Mixed"}


@query(
    "P11_code_labels",
    "SELECT c_custkey, CASE c_nationkey " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in FARM_TYPES.items()) + " ELSE 'None' END AS farm_type FROM customer",
)
def p11(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.label_codes("c_nationkey", FARM_TYPES, "None").alias("farm_type"))


BINS = [0, 0.01, 0.03, 0.05, 0.08, 1]
BIN_NAMES = ["0-1%", "1-3%", "3-5%", "5-8%", "8%+"]


@query(
    "P12_fixed_bins",
    "SELECT l_orderkey, l_linenumber, CASE " + " ".join(f"WHEN l_discount > {a} AND l_discount <= {b} THEN '{n}'" for a, b, n in zip(BINS[:-1], BINS[1:], BIN_NAMES)) + " END AS band FROM lineitem",
)
def p12(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", X.bin_label("l_discount", BINS, BIN_NAMES).alias("band"))


@query("P13_null_defaults", f"WITH {FARMS_SQL} SELECT id_business, coalesce(ha_peas, 0) AS ha_peas, coalesce(ha_moorland, ha_fenland, -1) AS ha_rough FROM farms")
def p13(spark, sf):
    f = farms(spark, sf).select("id_business", "ha_peas", F.coalesce("ha_moorland", "ha_fenland", F.lit(-1.0)).alias("ha_rough"))
    return f.na.fill(0.0, ["ha_peas"])


@query("P14_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def p14(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query(
    "P14_distinct_on_subset",
    "SELECT * FROM (SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_orderkey, l_partkey, l_quantity, l_extendedprice) = 1)",
)
def p14_subset(spark, sf):
    order = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")]
    return T.first_by(table(spark, sf, "lineitem"), ["l_suppkey", "l_linenumber"], order).select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("P15_post_filter", f"WITH {FARMS_SQL} SELECT id_business, ha_peas FROM farms WHERE ha_peas IS NOT NULL AND ha_peas > 10")
def p15(spark, sf):
    return farms(spark, sf).where("ha_peas IS NOT NULL AND ha_peas > 10").select("id_business", "ha_peas")


@query("P16_outlier_trim", "SELECT event_id, value FROM events WHERE value != 0 AND abs(value) < 3 * (SELECT stddev_samp(value) FROM events)")
def p16(spark, sf):
    return T.trim_outliers(table(spark, sf, "events").select("event_id", "value"), "value")


# -- J: equi-joins -------------------------------------------------------------------


@query(
    "J13_inner_keys",
    "SELECT p_partkey, s_suppkey, l_linenumber, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size > 10",
)
def j13(spark, sf):
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").where("p_size > 10")
    supp = table(spark, sf, "supplier")
    return li.join(part, li.l_partkey == part.p_partkey).join(supp, li.l_suppkey == supp.s_suppkey).select("p_partkey", "s_suppkey", "l_linenumber", "l_quantity")


@query("J14_left_keep", "SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey")
def j14(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_totalprice")


@query("J15_right_keep", "SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 400000) RIGHT JOIN customer ON o_custkey = c_custkey")
def j15(spark, sf):
    o = table(spark, sf, "orders").where("o_totalprice > 400000")
    return o.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select("o_orderkey", "c_custkey")


def _counts(spark, sf, flag, name):
    return table(spark, sf, "lineitem").where(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("key")).agg(F.count("*").alias(name))


@query(
    "J16_full_outer_chain",
    "SELECT key, coalesce(n_a, 0) AS n_a, coalesce(n_n, 0) AS n_n, coalesce(n_r, 0) AS n_r FROM (SELECT l_partkey AS key, count(*) AS n_a FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)"
    " FULL JOIN (SELECT l_partkey AS key, count(*) AS n_n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) USING (key)"
    " FULL JOIN (SELECT l_partkey AS key, count(*) AS n_r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (key)",
)
def j16(spark, sf):
    a, n, r = (_counts(spark, sf, f, f"n_{f.lower()}") for f in "ANR")
    return a.join(n, "key", "outer").join(r, "key", "outer").na.fill(0)


@query("J17_anti", "SELECT c_custkey, 'none' AS status FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def j17(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", F.lit("none").alias("status"))


@query(
    "J18_semi_by_group",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END) > 0)",
)
def j18(spark, sf):
    o = table(spark, sf, "orders")
    live = o.groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).otherwise(0)).alias("s")).where("s > 0")
    return o.join(live, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


LOOKUP_SQL = "lookup AS (SELECT p_type, p_brand, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 2 = 0 END AS want, p_size FROM part)"


@query(
    "J19_wildcard_match",
    f"WITH {LOOKUP_SQL} SELECT DISTINCT s_suppkey, p_type FROM supplier JOIN lookup ON 'Brand#' || CAST(s_nationkey AS VARCHAR) = p_brand AND (want IS NULL OR want = (s_suppkey % 2 = 0))",
)
def j19(spark, sf):
    lookup = table(spark, sf, "part").select("p_type", "p_brand", F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 2 == 0).alias("want")).distinct()
    s = table(spark, sf, "supplier").withColumn("brand", F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")))
    wild = lookup.want.isNull() | (lookup.want == (s.s_suppkey % 2 == 0))
    return s.join(lookup, (s.brand == lookup.p_brand) & wild).select("s_suppkey", "p_type").distinct()


@query("J20_unmatched_keys", "SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)")
def j20(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"))
    return rules.unmatched(li, table(spark, sf, "part").where("p_size < 40").select(F.col("p_partkey").alias("key")), ["key"])


@query("J21_validated_merge", "SELECT n_nationkey, n_name, s_suppkey FROM nation JOIN supplier ON n_nationkey = s_nationkey")
def j21(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), "s_suppkey")
    return rules.merge_validated(n, s, ["key"], expect="1:m").withColumnRenamed("key", "n_nationkey")


# -- A: aggregates ---------------------------------------------------------------------


@query(
    "A1_group_measures",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(avg(l_discount), 6) AS avg_disc, min(l_shipdate) AS first_ship, max(l_extendedprice) AS max_price FROM lineitem GROUP BY ALL",
)
def a1(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_shipdate").alias("first_ship"), F.max("l_extendedprice").alias("max_price")
    )


@query(
    "A2_conditional_sums",
    "SELECT l_suppkey, " + ", ".join(f"coalesce(sum(CASE WHEN l_returnflag = '{f}' THEN l_quantity END), 0) AS qty_{f}" for f in "ANR") + ", sum(l_quantity * CAST(l_linestatus = 'F' AS INT)) AS qty_filled FROM lineitem GROUP BY 1",
)
def a2(spark, sf):
    qty = F.col("l_quantity")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        *[F.coalesce(F.sum(F.when(F.col("l_returnflag") == f, qty)), F.lit(0.0)).alias(f"qty_{f}") for f in "ANR"],
        F.sum(qty * (F.col("l_linestatus") == "F").cast("int")).alias("qty_filled"),
    )


@query(
    "A3_weighted_means",
    "SELECT l_partkey, round(sum(w * l_quantity) / sum(w) + 1e-7, 5) AS l_quantity, round(sum(w * l_discount) / sum(w) + 1e-7, 5) AS l_discount FROM (SELECT *, CAST(l_linenumber - 2 AS DOUBLE) AS w FROM lineitem) WHERE w > 0 GROUP BY 1",
)
def a3(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("w", (F.col("l_linenumber") - 2).cast("double"))
    out = T.weighted_means(li, ["l_partkey"], "w", ["l_quantity", "l_discount"], 9)
    return out.withColumns({c: F.round(F.col(c) + 1e-7, 5) for c in ("l_quantity", "l_discount")})


@query(
    "A4_null_aware_mean",
    f"WITH {FARMS_SQL} SELECT farm_type, round(coalesce(sum(ha_peas * ha_potatoes) / sum(ha_peas), 0), 6) AS mean, count(DISTINCT ha_moorland) AS n_moor FROM farms GROUP BY 1",
)
def a4(spark, sf):
    return farms(spark, sf).groupBy("farm_type").agg(
        F.round(T.weighted_mean_or_zero("ha_potatoes", "ha_peas"), 6).alias("mean"), F.count_distinct("ha_moorland").alias("n_moor")
    )


@query("A5_clamped_sums", "SELECT l_orderkey, round(least(greatest(sum(l_discount * 4), 0), 1), 6) AS p, round(least(1, sum(l_tax * 5)), 6) AS q FROM lineitem GROUP BY 1")
def a5(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_discount") * 4).alias("d"), (F.col("l_tax") * 5).alias("t"))
    return li.groupBy("l_orderkey").agg(F.round(T.clamped_sum("d"), 6).alias("p"), F.round(T.clamped_sum("t", None, 1.0), 6).alias("q"))


@query("A6_collected_sets", "SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def a6(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(T.joined_set("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("n_parts"))


@query("A7_global_totals", "SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem")
def a7(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query(
    "A8_two_levels",
    "SELECT l_orderkey, round(avg(q), 6) AS mean_qty, count(*) AS n_parts, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS parts FROM (SELECT l_orderkey, l_partkey, max(l_quantity) AS q FROM lineitem GROUP BY ALL) GROUP BY 1",
)
def a8(spark, sf):
    once = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.max("l_quantity").alias("q"))
    return once.groupBy("l_orderkey").agg(F.round(F.avg("q"), 6).alias("mean_qty"), F.count("*").alias("n_parts"), T.joined_set("l_partkey").alias("parts"))


@query(
    "A9_pivot_wide",
    "SELECT l_orderkey, " + ", ".join(f"max(CASE WHEN l_returnflag = '{f}' THEN n END) AS flag_{f}" for f in "ANR") + " FROM (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1",
)
def a9(spark, sf):
    long = table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("name")).agg(F.count("*").alias("value"))
    return T.pivot_wide(long, values=list("ANR")).withColumnsRenamed({f: f"flag_{f}" for f in "ANR"})


@query(
    "A10_pivot_long",
    "SELECT l_orderkey, l_linenumber, l_partkey, name, value FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT INCLUDE NULLS (value FOR name IN (l_quantity, l_discount, l_tax))",
)
def a10(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return T.pivot_long(li, ["l_quantity", "l_discount", "l_tax"])


PERIODS = ["2021_2028", "2021_2036", "2021_2050", "2021_2100"]
PANEL = (
    "SELECT p_partkey AS id_parcel, p_type AS woodland_type, CASE WHEN p_partkey % 2 = 0 THEN '45' ELSE '85' END AS rcp, period, years,"
    " CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS species_1, p_name AS species_2, CAST(p_size AS DOUBLE) AS area_1, CAST(p_size % 7 AS DOUBLE) AS area_2,"
    " CAST(p_size % 10 AS DOUBLE) / 10 AS open_space, CAST(p_size * 2 + years AS DOUBLE) AS carbon, CAST(p_size % 5 AS DOUBLE) AS yield_1"
    " FROM part CROSS JOIN (VALUES ('2021_2028', 8), ('2021_2036', 16), ('2021_2050', 30), ('2021_2100', 80)) AS t(period, years)"
)


def panel(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("part")
    return spark.sql(PANEL)


@query(
    "A11_struct_stack",
    f"""WITH panel AS ({PANEL}) SELECT id_parcel, period, species, area, yield FROM (
        SELECT id_parcel, period, species_1 AS species, area_1 AS area, yield_1 AS yield FROM panel UNION ALL SELECT id_parcel, period, species_2, area_2, NULL FROM panel
        UNION ALL SELECT id_parcel, period, 'OPENSPACE', open_space, NULL FROM panel) WHERE species IS NOT NULL""",
)
def a11(spark, sf):
    c = F.col
    null = F.lit(None).cast("double")
    groups = [
        {"species": c("species_1"), "area": c("area_1"), "yield": c("yield_1")},
        {"species": c("species_2"), "area": c("area_2"), "yield": null},
        {"species": F.lit("OPENSPACE"), "area": c("open_space"), "yield": null},
    ]
    return T.stack_structs(panel(spark, sf), groups, ["id_parcel", "period"]).where("species IS NOT NULL")


@query(
    "A12_multi_metric_pivot",
    f"WITH panel AS ({PANEL}) SELECT woodland_type, rcp, " + ", ".join(f"{a}(CASE WHEN period = '{p}' THEN carbon END) AS p{p}_{n}" for p in PERIODS for a, n in (("sum", "total"), ("max", "top"), ("count", "n"))) + " FROM panel GROUP BY ALL",
)
def a12(spark, sf):
    wide = panel(spark, sf).groupBy("woodland_type", "rcp").pivot("period", PERIODS)
    out = wide.agg(F.sum("carbon").alias("total"), F.max("carbon").alias("top"), F.count("carbon").alias("n"))
    return out.withColumnsRenamed({c: f"p{c}" for c in out.columns[2:]}).na.fill(0, [f"p{p}_n" for p in PERIODS])


@query(
    "A13_combine_wide",
    "SELECT id_parcel, proportion_a, proportion_n, proportion_r FROM (SELECT l_orderkey AS id_parcel, round(max(l_discount), 6) AS proportion_a FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)"
    " FULL JOIN (SELECT l_orderkey AS id_parcel, round(max(l_discount), 6) AS proportion_n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) USING (id_parcel)"
    " FULL JOIN (SELECT l_orderkey AS id_parcel, round(max(l_discount), 6) AS proportion_r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (id_parcel)",
)
def a13(spark, sf):
    li = table(spark, sf, "lineitem")
    frames = [li.where(F.col("l_returnflag") == f).groupBy(F.col("l_orderkey").alias("id_parcel")).agg(F.round(F.max("l_discount"), 6).alias("proportion")) for f in "ANR"]
    return T.combine_wide(frames, ["a", "n", "r"])


@query(
    "A14_subtotals",
    "SELECT l_returnflag AS action_group, l_linestatus AS action_habitat, CAST(sum(l_quantity) AS DOUBLE) AS qty FROM lineitem GROUP BY ALL"
    " UNION ALL SELECT l_returnflag, 'action_group_total', sum(l_quantity) FROM lineitem GROUP BY 1 UNION ALL SELECT 'A and R', 'action_group_total', sum(l_quantity) FROM lineitem WHERE l_returnflag IN ('A', 'R')",
)
def a14(spark, sf):
    lookup = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("action_group"), F.col("l_linestatus").alias("action_habitat")).agg(F.sum("l_quantity").alias("qty"))
    totals = T.with_subtotals(lookup, {"action_habitat": "action_group_total"})
    both = lookup.where("action_group IN ('A', 'R')").withColumns({"action_group": F.lit("A and R"), "action_habitat": F.lit("action_group_total")})
    return totals.unionByName(both).groupBy("action_group", "action_habitat").agg(F.sum("qty").alias("qty"))


@query(
    "A15_category_panel",
    f"""WITH {FARMS_SQL}, feats AS (SELECT id_business, name, value FROM (SELECT id_business, ha_peas, ha_potatoes, ha_moorland FROM farms) UNPIVOT INCLUDE NULLS (value FOR name IN (ha_peas, ha_potatoes, ha_moorland))),
        groups AS (SELECT id_business, 'type' AS category, farm_type AS grp FROM farms UNION ALL SELECT id_business, 'size', CASE WHEN id_business % 2 = 0 THEN 'even' ELSE 'odd' END FROM farms)
        SELECT category, grp, """
    + ", ".join(f"coalesce(sum(CASE WHEN name = '{m}' THEN value END), 0) AS {m}_sum, round(avg(CASE WHEN name = '{m}' THEN value END), 6) AS {m}_mean" for m in ("ha_peas", "ha_potatoes", "ha_moorland"))
    + " FROM feats JOIN groups USING (id_business) GROUP BY ALL",
)
def a15(spark, sf):
    f = farms(spark, sf)
    metrics = ["ha_peas", "ha_potatoes", "ha_moorland"]
    feats = T.pivot_long(f.select("id_business", *metrics), metrics)
    size = F.when(F.col("id_business") % 2 == 0, "even").otherwise("odd")
    groups = T.pivot_long(f.select("id_business", F.col("farm_type").alias("type"), size.alias("size")), ["type", "size"], "category", "grp")
    wide = feats.join(groups, "id_business").groupBy("category", "grp").pivot("name", metrics)
    out = wide.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("sum"), F.round(F.avg("value"), 6).alias("mean"))
    return out


@query(
    "A16_multi_statistics",
    "SELECT l_returnflag, metric, stat, value FROM (SELECT l_returnflag, split_part(name, '_', 1) AS metric, split_part(name, '_', 2) AS stat, value FROM (SELECT l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS qty_sum, CAST(count(l_quantity) AS DOUBLE) AS qty_count, CAST(median(l_quantity) AS DOUBLE) AS qty_median, round(avg(l_quantity), 6) AS qty_mean,"
    " round(sum(l_discount), 4) AS disc_sum, CAST(count(l_discount) AS DOUBLE) AS disc_count, median(l_discount) AS disc_median, round(avg(l_discount), 6) AS disc_mean FROM lineitem GROUP BY 1)"
    " UNPIVOT (value FOR name IN (qty_sum, qty_count, qty_median, qty_mean, disc_sum, disc_count, disc_median, disc_mean)))",
)
def a16(spark, sf):
    items, stats = table(spark, sf, "lineitem"), []
    for short, c, digits in (("qty", "l_quantity", 4), ("disc", "l_discount", 4)):
        stats += [F.round(F.sum(c), digits).alias(f"{short}_sum"), F.count(c).cast("double").alias(f"{short}_count"), F.round(F.avg(c), 6).alias(f"{short}_mean")]
    wide = items.groupBy("l_returnflag").agg(*stats)
    for short, c in (("qty", "l_quantity"), ("disc", "l_discount")):
        wide = with_quantiles(wide, items, ["l_returnflag"], c, {f"{short}_median": 0.5})
    long = T.pivot_long(wide, wide.columns[1:])
    part = F.split("name", "_")
    return long.select("l_returnflag", part[0].alias("metric"), part[1].alias("stat"), "value")


@query(
    "A17_quantiles",
    "SELECT event_type, round(median(value), 6) AS median, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.9), 6) AS q90, min(value) AS min, max(value) AS max, round(stddev_samp(value), 6) AS std FROM events GROUP BY 1",
)
def a17(spark, sf):
    events = table(spark, sf, "events")
    rest = events.groupBy("event_type").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.round(F.stddev("value"), 6).alias("std"))
    out = with_quantiles(rest, events, ["event_type"], "value", {"median": 0.5, "q25": 0.25, "q90": 0.9})
    return out.withColumns({c: F.round(c, 6) for c in ("median", "q25", "q90")})


@query(
    "A18_match_rate",
    "SELECT l_returnflag, sum(CASE WHEN hit THEN 1 ELSE 0 END)::BIGINT AS n_true, sum(CASE WHEN hit THEN 0 ELSE 1 END)::BIGINT AS n_false, round(100.0 * sum(CASE WHEN hit THEN 1 ELSE 0 END) / count(*), 6) AS pct_true FROM (SELECT l_orderkey, l_returnflag, bool_or(l_discount > 0.08) AS hit FROM lineitem GROUP BY ALL) GROUP BY 1",
)
def a18(spark, sf):
    once = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.bool_or(F.col("l_discount") > 0.08).alias("hit"))
    return once.groupBy("l_returnflag").agg(
        F.count_if("hit").alias("n_true"), F.count_if(~F.col("hit")).alias("n_false"), F.round(100 * F.count_if("hit") / F.count("*"), 6).alias("pct_true")
    )


@query("A19_frequency", "SELECT p_type, count(DISTINCT l_orderkey) AS n_orders, CAST(sum(l_quantity) AS DOUBLE) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY qty DESC")
def a19(spark, sf):
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return joined.groupBy("p_type").agg(F.count_distinct("l_orderkey").alias("n_orders"), F.sum("l_quantity").alias("qty")).orderBy(F.col("qty").desc())


@query("A20_grid_totals", with_sql("trees") + "SELECT (x0 // 500) * 500 AS cell_x, (y0 // 500) * 500 AS cell_y, count(*) AS n, CAST(sum(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks FROM trees GROUP BY ALL")
def a20(spark, sf):
    t = layer(spark, sf, "trees").select("x0", "y0", F.lit(1).alias("n"), (F.col("kind") == "click").cast("int").alias("clicks"))
    return T.grid_totals(t, "x0", "y0", 500, ["n", "clicks"])


@query("A21_group_share", "SELECT o_orderkey, o_custkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 9) AS share FROM orders")
def a21(spark, sf):
    out = T.with_group_total(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], "o_totalprice")
    return out.select("o_orderkey", "o_custkey", F.round("share", 9).alias("share"))


@query(
    "A22_period_rollup",
    f"""WITH panel AS ({PANEL}) SELECT id_parcel, rcp, period, round(carbon, 6) AS carbon, area_1 FROM panel WHERE rcp = '45' UNION ALL
        SELECT id_parcel, rcp, '2021_2050_all', round(sum(carbon * y) / sum(y), 6), sum(area_1 * f) FROM (SELECT *, CASE WHEN period = '2021_2100' THEN 0.4 ELSE 1.0 END AS f, years * CASE WHEN period = '2021_2100' THEN 0.4 ELSE 1.0 END AS y FROM panel) WHERE rcp = '45' GROUP BY 1, 2""",
)
def a22(spark, sf):
    out = T.period_rollup(panel(spark, sf), ["id_parcel", "rcp"], "period", "2021_2050_all", ["carbon"], ["area_1"], "years", {"2021_2100": 20 / 50})
    return out.where("rcp = '45'").withColumn("carbon", F.round("carbon", 6))


@query(
    "A23_null_census",
    f"WITH {FARMS_SQL} SELECT farm_type, count(*) FILTER (ha_peas = 0) AS n_zero, count(*) FILTER (ha_peas = 1) AS n_one, count(*) FILTER (ha_peas NOT IN (0, 1)) AS n_other, count(*) FILTER (ha_peas IS NULL) AS n_null, round(count(*) FILTER (ha_peas IS NULL) / count(*), 9) AS null_share, round(avg(ha_peas), 6) AS mean, min(ha_peas) AS min, max(ha_peas) AS max FROM farms GROUP BY 1",
)
def a23(spark, sf):
    out = farms(spark, sf).groupBy("farm_type").agg(*T.census("ha_peas"))
    return out.withColumns({"null_share": F.round("null_share", 9), "mean": F.round("mean", 6)})


@query(
    "A24_scenario_grid",
    f"WITH {FARMS_SQL}, s AS (SELECT * FROM (VALUES (100.0, true), (100.0, false), (250.0, true), (250.0, false)) t(rate, with_fallow)) SELECT CAST(rate AS DOUBLE) AS rate, with_fallow, farm_type, sum(rate * (coalesce(ha_peas, 0) + CASE WHEN with_fallow THEN coalesce(ha_beans, 0) ELSE 0 END))::DOUBLE AS payment, count(*) FILTER (ha_peas > 20) AS n_large FROM farms, s GROUP BY ALL",
)
def a24(spark, sf):
    scenarios = spark.createDataFrame([(100.0, True), (100.0, False), (250.0, True), (250.0, False)], "rate double, with_fallow boolean")
    metrics = {
        "payment": "sum(rate * (coalesce(ha_peas, 0) + CASE WHEN with_fallow THEN coalesce(ha_beans, 0) ELSE 0 END))",
        "n_large": "count_if(ha_peas > 20)",
    }
    return T.scenario_grid(farms(spark, sf), ["farm_type"], scenarios, metrics)


@query(
    "A25_uptake_statistics",
    "WITH b AS (SELECT o_custkey, CAST(sum(o_totalprice) AS DOUBLE) AS value FROM orders GROUP BY 1), t AS (SELECT avg(value) AS mean, median(value) AS median FROM b)"
    " SELECT count(*) FILTER (value > mean) AS uptake_mean, count(*) FILTER (value > median) AS uptake_median, round(sum(CASE WHEN value > mean THEN value END), 2) AS cost_mean, round(sum(CASE WHEN value > median THEN value END), 2) AS cost_median, round(500.0 * count(*) FILTER (value > mean) / sum(CASE WHEN value > mean THEN value END), 9) AS admin_ratio FROM b, t",
)
def a25(spark, sf):
    b = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("value"))
    t = with_quantiles(b.agg(F.avg("value").alias("mean")), b, [], "value", {"median": 0.5})  # one row
    rows = b.crossJoin(F.broadcast(t))
    v, over_mean, over_median = F.col("value"), F.col("value") > F.col("mean"), F.col("value") > F.col("median")
    return rows.agg(
        F.count_if(over_mean).alias("uptake_mean"), F.count_if(over_median).alias("uptake_median"),
        F.round(F.sum(F.when(over_mean, v)), 2).alias("cost_mean"), F.round(F.sum(F.when(over_median, v)), 2).alias("cost_median"),
        F.round(500.0 * F.count_if(over_mean) / F.sum(F.when(over_mean, v)), 9).alias("admin_ratio"),
    )


@query(
    "A26_cohort_filter",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL",
)
def a26(spark, sf):
    o = table(spark, sf, "orders")
    cohort = o.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    kept = o.join(cohort, "o_custkey", "left_semi").where("o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
    return kept.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query(
    "A27_split_by_share",
    f"WITH {FARMS_SQL}, m AS (SELECT id_business, {ARABLE_SQL} AS a, {GRASS_SQL} AS g, CAST(id_business % 90 AS DOUBLE) AS m FROM farms) SELECT round(sum(m * a / (a + g)), 6) AS m_arable, round(sum(m * (1 - a / (a + g))), 6) AS m_grassland FROM m WHERE a + g > 0",
)
def a27(spark, sf):
    arable, grass = T.sum_columns([f"ha_{c}" for c in ARABLE]), T.sum_columns([f"ha_{c}" for c in GRASSLAND])
    m = farms(spark, sf).select(arable.alias("a"), grass.alias("g"), (F.col("id_business") % 90).cast("double").alias("m"))
    share = F.try_divide(F.col("a"), F.col("a") + F.col("g"))
    return m.agg(F.round(F.sum(F.col("m") * share), 6).alias("m_arable"), F.round(F.sum(F.col("m") * (1 - share)), 6).alias("m_grassland"))


@query(
    "A28_trend_table",
    "SELECT year, round(avg(l_discount), 6) AS all_mean, " + ", ".join(f"round(avg(CASE WHEN l_returnflag = '{f}' THEN l_discount END), 6) AS mean_{f}" for f in "AR") + ", round(avg(CASE WHEN l_discount > 0.035 THEN 1.0 ELSE 0.0 END), 6) AS over_35, round(avg(CASE WHEN l_discount > 0.023 THEN 1.0 ELSE 0.0 END), 6) AS over_23 FROM (SELECT *, CAST(year(l_shipdate) AS INT) AS year FROM lineitem) GROUP BY 1",
)
def a28(spark, sf):
    d = F.col("l_discount")
    return table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        F.round(F.avg(d), 6).alias("all_mean"),
        *[F.round(F.avg(F.when(F.col("l_returnflag") == f, d)), 6).alias(f"mean_{f}") for f in "AR"],
        F.round(F.avg((d > 0.035).cast("double")), 6).alias("over_35"),
        F.round(F.avg((d > 0.023).cast("double")), 6).alias("over_23"),
    )


# -- W: windows ---------------------------------------------------------------------------


@query("W1_row_number_top", "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 3")
def w1(spark, sf):
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    return ranking.best_rows(table(spark, sf, "lineitem"), ["l_suppkey"], order, 3).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@query(
    "W2_rank_in_sum",
    "SELECT l_orderkey, CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS INT) AS n_first, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_suppkey ORDER BY l_quantity, l_linenumber, l_partkey) AS rn FROM lineitem) GROUP BY 1",
)
def w2(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("l_orderkey", "l_returnflag", "l_suppkey").orderBy("l_quantity", "l_linenumber", "l_partkey")
    ranked = table(spark, sf, "lineitem").withColumn("rn", F.row_number().over(w))
    return ranked.groupBy("l_orderkey").agg(F.sum(F.when(F.col("rn") == 1, 1).otherwise(0)).cast("int").alias("n_first"), F.count("*").alias("n"))


@query(
    "W3_priority_ranking",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus = 'P' END DESC NULLS LAST, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus = 'F' END DESC NULLS LAST, o_orderpriority ASC, o_totalprice > 200000 DESC, o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def w3(spark, sf):
    o = table(spark, sf, "orders")
    order = [
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus") == "P").desc_nulls_last(),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus") == "F").desc_nulls_last(),
        F.col("o_orderpriority").asc(),
        (F.col("o_totalprice") > 200000).desc(),
        F.col("o_totalprice").desc(),
        F.col("o_orderkey").asc(),
    ]
    return ranking.best_rows(o, ["o_custkey"], order).select("o_custkey", "o_orderkey")


@query("W4_default_ranking", "SELECT l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate ASC, l_extendedprice DESC, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn = 1")
def w4(spark, sf):
    order = [F.col("l_shipdate").asc(), F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_partkey")]
    return ranking.best_rows(table(spark, sf, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("W5_global_quintile", "SELECT event_id, CAST(ntile(5) OVER (ORDER BY coalesce(value, 0), event_id) AS INT) AS quintile FROM events")
def w5(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.coalesce("value", F.lit(0.0)).alias("value"))
    return ranking.ntile(e, "value", "event_id", 5, "quintile").select("event_id", "quintile")


@query("W5_quintile_many_ties", "SELECT k, CAST(ntile(5) OVER (ORDER BY CASE WHEN l_linenumber < 5 THEN 0 ELSE l_quantity END, k) AS INT) AS quintile FROM (SELECT *, l_orderkey * 1000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS k FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber ORDER BY l_quantity) = 1)")
def w5_ties(spark, sf):
    key = (F.col("l_orderkey") * 1000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("k")
    v = F.when(F.col("l_linenumber") < 5, F.lit(0.0)).otherwise(F.col("l_quantity"))
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"))
    return ranking.ntile(li.select(key, v.alias("v")), "v", "k", 5, "quintile").select("k", "quintile")


@query("W6_quintile_of_maximum", "SELECT l_orderkey, CAST(ntile(5) OVER (ORDER BY max(l_extendedprice), l_orderkey) AS INT) AS score FROM lineitem GROUP BY 1")
def w6(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("top"))
    return ranking.ntile(m, "top", "l_orderkey", 5, "score").select("l_orderkey", "score")


@query("W8_sequence_ids", "SELECT o_orderkey, pos, word FROM (SELECT o_orderkey, CAST(unnest(range(len(s))) AS INT) AS pos, unnest(s) AS word FROM (SELECT o_orderkey, string_split(o_orderpriority, '-') AS s FROM orders))")
def w8(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.posexplode(F.split("o_orderpriority", "-")).alias("pos", "word"))


@query("W9_batches", "SELECT o_orderstatus, batch, count(*) AS n, min(o_orderkey) AS first_key FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) // 500 AS batch FROM orders) GROUP BY ALL")
def w9(spark, sf):
    b = ranking.batches(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", "o_orderkey", 500)
    return b.groupBy("o_orderstatus", "batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query(
    "W10_average_rank",
    "SELECT p_partkey, p_size, r AS rank, r <= 100 AS is_top FROM (SELECT *, (min(rn) OVER (PARTITION BY p_size) + max(rn) OVER (PARTITION BY p_size)) / 2.0 AS r FROM (SELECT *, row_number() OVER (ORDER BY p_size DESC) AS rn FROM part))",
)
def w10(spark, sf):
    out = ranking.average_rank(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", "p_partkey")
    return out.withColumn("is_top", F.col("rank") <= 100)


# -- L: sorts and limits ---------------------------------------------------------------------


@query("L1_sorted", "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal FROM customer ORDER BY bal DESC NULLS LAST, c_custkey")
def l1(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("bal"))
    return c.orderBy(F.col("bal").desc_nulls_last(), "c_custkey")


SCENES = "SELECT 'S2' || CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END || '_MSIL2A_' || {date} || 'T110321_N0509_R094_T30U' || CASE WHEN o_orderkey % 3 = 0 THEN 'XC' ELSE 'YD' END || '_' || {date} || 'T150000.SAFE' AS name, o_orderkey FROM orders"


@query(
    "L2_scenes_by_date",
    "SELECT name, o_orderkey, strptime(regexp_extract(name, '_(\\d{8})T', 1), '%Y%m%d')::TIMESTAMP AS captured FROM (" + SCENES.format(date="strftime(o_orderdate, '%Y%m%d')") + ") ORDER BY captured DESC, name, o_orderkey",
)
def l2(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    s = spark.sql(SCENES.format(date="date_format(o_orderdate, 'yyyyMMdd')"))
    captured = F.to_timestamp(F.regexp_extract("name", r"_(\d{8})T", 1), "yyyyMMdd")
    return s.withColumn("captured", captured).orderBy(F.col("captured").desc(), "name", "o_orderkey")


@query("L3_sort_then_first", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1")
def l3(spark, sf):
    return T.first_by(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("L4_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def l4(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("L5_group_head", "SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY 1")
def l5(spark, sf):
    first = F.min_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id"))
    return table(spark, sf, "events").groupBy("user_id").agg(first.alias("f")).select("user_id", F.col("f.event_id").alias("first_event"), F.col("f.event_type").alias("first_type"))


@query(
    "L6_head_and_tail",
    "(SELECT o_custkey, total, 'head' AS \"end\" FROM t ORDER BY total DESC, o_custkey LIMIT 10) UNION ALL (SELECT o_custkey, total, 'tail' FROM t ORDER BY total ASC, o_custkey DESC LIMIT 10)".join(
        ["WITH t AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ", ""]
    ),
)
def l6(spark, sf):
    t = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return ranking.ends(t, "total", "o_custkey", 10)


# -- N: set operations --------------------------------------------------------------------------


@query("N1_union_by_name", "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def n1(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return s.unionByName(table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")))


@query("N2_union_missing", "SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def n2(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("N3_union_positional", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation")
def n3(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    return n.union(table(spark, sf, "region").select("r_name")).union(n)


@query("N4_combine_long", "SELECT 'supplier' AS source, s_suppkey AS id, s_acctbal AS bal, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_acctbal, c_mktsegment FROM customer")
def n4(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    return T.combine_long([s, c], ["supplier", "customer"])


@query("N5_union_distinct", "SELECT l_partkey AS key FROM lineitem WHERE l_quantity > 45 UNION SELECT l_partkey FROM lineitem WHERE l_discount > 0.09")
def n5(spark, sf):
    li = table(spark, sf, "lineitem")
    a, b = li.where("l_quantity > 45"), li.where("l_discount > 0.09")
    return a.select(F.col("l_partkey").alias("key")).union(b.select("l_partkey")).dropDuplicates()


@query("N6_set_difference", "SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def n6(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return c.subtract(table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey"))
