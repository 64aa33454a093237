"""Layer-wide geometry reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrain.functions import geometry as G

# Tiles of the national grid that cover the country at 100, 10 and 1 km.
TILE_COUNTS = {100_000: 91, 10_000: 9_100, 1_000: 910_000}


def resolution(rows, per_tile) -> Column:
    """The coarsest grid with more tiles than batches of `per_tile` rows; the finest if none has."""
    wanted = F.floor(G._col(rows) / (F.lit(per_tile) if isinstance(per_tile, int) else G._col(per_tile)))
    out = None
    for size, tiles in TILE_COUNTS.items():
        out = F.when(tiles > wanted, size) if out is None else out.when(tiles > wanted, size)
    return out.otherwise(min(TILE_COUNTS))


def census(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows and mean vertex count per geometry type."""
    return df.groupBy(G.geometry_type(geometry).alias("type")).agg(
        F.count("*").alias("n"), F.round(F.avg(G.vertex_count(geometry)), 1).alias("mean_vertices")
    )


def validity(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Counts of invalid, empty and missing geometries."""
    g = F.col(geometry)
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(g.isNotNull() & ~G.is_valid(geometry)).alias("n_invalid"),
        F.count_if(g.isNotNull() & G.is_empty(geometry)).alias("n_empty"),
        F.count_if(g.isNull()).alias("n_null"),
    )
