"""Geometry layers derived from the relational tables by integer arithmetic.

Every row takes the spot of its key on a lattice of 1000 columns and unlimited
rows with a 100 m pitch, so the number of neighbours of a row does not grow
with the tables.  Rectangles, axis-parallel lines, points and diamonds keep
closed forms that SQL can check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrain.functions import geometry as G
from landgrain.operators.spatial_join import Grid

CELL = Grid(cell=200.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Each layer is (source table, {column: integer expression}); the same text runs in Spark and in the check SQL.
# `//` marks integer division and is spelled per dialect.
LAYERS = {
    "parcels": (
        "orders",
        {
            "k": "o_orderkey",
            "id_parcel": "concat('S', chr(cast(65 + (o_orderkey // 100000000) % 26 as int)), lpad(cast(o_orderkey % 100000000 as varchar(20)), 8, '0'))",
            "id_business": "o_custkey",
            "x0": "(o_orderkey % 1000) * 100 + (o_orderkey * 7919) % 37",
            "y0": "(o_orderkey // 1000) * 100 + (o_orderkey * 104729) % 41",
            "w": "30 + (o_orderkey * 31) % 90",
            "h": "30 + (o_custkey * 17) % 80",
        },
    ),
    "features": (
        "lineitem",
        {
            "k": "l_orderkey * 8 + l_linenumber",
            "fid": "l_orderkey * 1000000 + l_partkey * 8 + l_linenumber",
            "class": "l_returnflag",
            "status": "l_linestatus",
            "x0": "(l_orderkey % 1000) * 100 + (l_partkey * 7) % 90",
            "y0": "(l_orderkey // 1000) * 100 + (l_suppkey * 11 + l_linenumber * 13) % 90",
            "w": "5 + l_linenumber * 6",
            "h": "5 + (l_partkey % 9) * 5",
        },
    ),
    "trees": (
        "events",
        {
            "k": "event_id",
            "kind": "event_type",
            "x0": "(event_id % 1000) * 100 + (user_id * 13) % 100",
            "y0": "(event_id // 1000) * 100 + (event_id * 57) % 100",
            "w": "0",
            "h": "0",
        },
    ),
    "hedges": (
        "customer",
        {
            "k": "c_custkey",
            "kind": "c_mktsegment",
            "x0": "(c_custkey % 1000) * 100 + (c_custkey * 29) % 60",
            "y0": "(c_custkey // 1000) * 100 + (c_custkey * 43) % 70",
            "w": "case when c_custkey % 2 = 0 then 10 + (c_custkey * 37) % 80 else 0 end",
            "h": "case when c_custkey % 2 = 0 then 0 else 10 + (c_custkey * 41) % 80 end",
        },
    ),
    "walls": (
        "part",
        {
            "k": "p_partkey",
            "kind": "p_type",
            "x0": "(p_partkey % 1000) * 100 + (p_partkey * 17) % 70",
            "y0": "(p_partkey // 1000) * 100 + (p_partkey * 53) % 80",
            "w": "case when p_partkey % 2 = 1 then 10 + p_size else 0 end",
            "h": "case when p_partkey % 2 = 1 then 0 else 10 + p_size end",
        },
    ),
    "water": (
        "supplier",
        {
            "k": "s_suppkey",
            "kind": "cast(s_nationkey % 3 as varchar(20))",
            "x0": "(s_suppkey % 1000) * 100 + (s_suppkey * 19) % 50",
            "y0": "(s_suppkey // 1000) * 100 + (s_suppkey * 23) % 50",
            "w": "20 + (s_suppkey * 3) % 60",
            "h": "6 + s_suppkey % 10",
        },
    ),
}


def _spark(expr: str) -> str:
    return expr.replace("//", "DIV").replace("varchar(20)", "string")


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A layer with its integer columns and a `geometry` of boxes, lines or points."""
    source, cols = LAYERS[name]
    named = table(spark, sf_dir, source).selectExpr(*[f"{_spark(e)} AS `{c}`" for c, e in cols.items()])
    shape = {"trees": G.point_sql("x0", "y0")}.get(name)
    if shape is None:
        shape = (G.segment_sql if name in ("hedges", "walls") else G.box_sql)("x0", "y0", "x0 + w", "y0 + h")
    return named.selectExpr("*", f"{shape} AS geometry")


def layer_sql(name: str) -> str:
    """The same layer for the check engine, with x1 and y1 and no geometry."""
    source, cols = LAYERS[name]
    body = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    return f"(SELECT *, x0 + w AS x1, y0 + h AS y1 FROM (SELECT {body} FROM {source}))"


def with_sql(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS {layer_sql(n)}" for n in names) + " "


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four sides of every parcel: west, north, east, south."""
    corners = [("x0", "y0", "x0", "y0 + h", "h"), ("x0", "y0 + h", "x0 + w", "y0 + h", "w"), ("x0 + w", "y0 + h", "x0 + w", "y0", "h"), ("x0 + w", "y0", "x0", "y0", "w")]
    sides = ", ".join(
        f"named_struct('id_boundary', k * 4 + {n}, 'geometry', {G.segment_sql(ax, ay, bx, by)}, 'm', double({m}))"
        for n, (ax, ay, bx, by, m) in enumerate(corners)
    )
    return layer(spark, sf_dir, "parcels").selectExpr("id_parcel", f"inline(array({sides}))")


SEGMENTS_SQL = """segments AS (
    SELECT id_parcel, k * 4 + n AS id_boundary,
           CASE WHEN n = 2 THEN x1 ELSE x0 END AS sx0, CASE WHEN n = 1 THEN y1 ELSE y0 END AS sy0,
           CASE WHEN n = 0 THEN x0 ELSE x1 END AS sx1, CASE WHEN n = 3 THEN y0 ELSE y1 END AS sy1,
           CAST(CASE WHEN n % 2 = 0 THEN h ELSE w END AS DOUBLE) AS m
    FROM parcels, (VALUES (0), (1), (2), (3)) AS t(n))"""


ROWS_PER_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Share out the rows of a few small files before costly per-geometry work, so many rows to a task at most."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK)))
