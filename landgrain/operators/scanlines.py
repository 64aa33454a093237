"""Polygons as spans of raster cells.

A span is (row, first, last): a stretch of one raster row whose cell centres lie in
the polygon.  Every edge gives the rows whose centre line it crosses and the first
cell whose centre is not left of the crossing; sorted by row and cell, two crossings
after each other bound a span.  The work and the array grow with the rows an outline
crosses, not with the cells it holds.

Outline rule: a centre on a left or lower outline is inside, one on a right or upper
outline is outside, so polygons that share an edge never share a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrain.functions import geometry as G

BLOCK = 64
"""Cells of a row that meet as one key in a join."""


def _edges(ring: Column) -> Column:
    starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.transform(starts, lambda v, i: F.struct(v["x"].alias("x0"), v["y"].alias("y0"), ring[i + 1]["x"].alias("x1"), ring[i + 1]["y"].alias("y1")))


def _first_centre(x: Column, origin: float, res: float) -> Column:
    """Number of the first cell whose centre is at x or beyond."""
    return F.ceil((x - origin) / res - 0.5)


def spans(g, res: float, x0: float = 0.0, y0: float = 0.0) -> Column:
    """Spans of the polygon parts of a geometry, as an array ordered by row; none for points and lines."""
    g, res = G._col(g), float(res)
    areas = F.filter(g["parts"], lambda p: p["dim"] == 2)
    edges = F.flatten(F.transform(areas, lambda p: F.flatten(F.transform(p["rings"], _edges))))
    ranged = F.transform(
        edges,
        lambda e: F.struct(
            e.alias("e"),
            _first_centre(F.least(e["y0"], e["y1"]), y0, res).alias("low"),
            (_first_centre(F.greatest(e["y0"], e["y1"]), y0, res) - 1).alias("high"),
        ),
    )

    def crossings(m: Column) -> Column:
        e = m["e"]

        def crossing(row: Column) -> Column:
            y = (row + 0.5) * res + y0
            x = e["x0"] + (y - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"])
            return F.struct(row.alias("row"), _first_centre(x, x0, res).alias("cell"))

        return F.transform(F.sequence(m["low"], m["high"]), crossing)

    crossed = F.flatten(F.transform(F.filter(ranged, lambda m: m["low"] <= m["high"]), crossings))
    return F.filter(_paired(F.array_sort(crossed)), lambda s: s["first"] <= s["last"])


def _paired(ordered: Column) -> Column:
    """Spans between the crossings 0 and 1, 2 and 3, and so on."""
    starts = F.filter(ordered, lambda c, i: i % 2 == 0)
    ends = F.filter(ordered, lambda c, i: i % 2 == 1)
    return F.zip_with(starts, ends, lambda a, b: F.struct(a["row"].alias("row"), a["cell"].alias("first"), (b["cell"] - 1).alias("last")))


def cells(df: DataFrame, res: float, x0: float = 0.0, y0: float = 0.0, geometry: str = "geometry") -> DataFrame:
    """One row per cell whose centre a polygon holds, with `row` and `col`; other columns but the geometry are kept.

    Spans become rows first, so no array holds more than one row of one polygon.
    """
    rows = df.withColumn("_spans", spans(geometry, res, x0, y0)).drop(geometry)
    rows = rows.select("*", F.inline("_spans")).drop("_spans")
    return rows.select("*", F.explode(F.sequence("first", "last")).alias("col")).drop("first", "last")


def cells_within(zones: DataFrame, pixels: DataFrame, key: str, res: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Pixels (row, col, ...) whose centre lies in a zone, each with the zone's key.

    Spans are cut at multiples of BLOCK cells and meet the pixels on (row, block).  A pixel
    column named like the key gives way to the key.
    """
    found = zones.select(F.col(key).alias("_zone"), F.inline(spans("geometry", res, x0, y0)))
    found = found.select("_zone", F.col("row").alias("_row"), "first", "last", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))).alias("_block"))
    found = found.withColumnsRenamed({"first": "_first", "last": "_last"})
    held = pixels.drop(key).withColumn("_block", F.floor(F.col("col") / BLOCK))
    met = held.join(found, (F.col("row") == F.col("_row")) & (held["_block"] == found["_block"]) & F.col("col").between(F.col("_first"), F.col("_last")))
    return met.drop("_block", "_row", "_first", "_last").withColumnRenamed("_zone", key)
