"""Counts of point features by nearest boundary, and parcel summaries of them."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from landgrain.functions import geometry as G
from landgrain.operators.linear import BUFFERS
from landgrain.operators.spatial_join import Grid, sjoin, unbroadcast


def _snapped(features: DataFrame, key: str, snap: float | None) -> DataFrame:
    """Optionally snap points to a grid and keep one per position."""
    slim = features.select(F.col(key).alias("_fid"), "geometry")
    if not snap:
        return slim
    return slim.withColumn("geometry", G.snap("geometry", snap)).groupBy("geometry").agg(F.min("_fid").alias("_fid"))


def nearest_segment_counts(
    segments: DataFrame,
    features: DataFrame,
    feature_key: str,
    buffers: list[float] = BUFFERS,
    key: str = "id_parcel",
    segment_key: str = "id_boundary",
    snap: float | None = None,
    drop_empty: bool = False,
    grid: Grid = Grid(),
    **kw,
) -> DataFrame:
    """Features within each buffer of a segment, each counted at the nearest segment of the parcel only.

    Equal distances go to the smaller segment key.  Every segment with some
    feature near is listed.  Lines have no area, so nothing lies within 0 m;
    drop_empty leaves out buffer columns that are zero throughout.
    """
    feats = _snapped(features, feature_key, snap)
    # the left side is listed with the distance around it, so the segments, which are many, are the right side
    near = sjoin(feats, segments.select(segment_key, key, "m", "geometry"), float(max(buffers)), grid, distance_col="_d", **kw)
    # one parcel's segments around one feature: a handful of rows per window
    order = W.partitionBy(key, "_fid").orderBy("_d", segment_key)
    ranked = near.select(segment_key, key, "m", "_fid", "_d").withColumn("_rank", F.row_number().over(order))
    counted = [b for b in buffers if b > 0]
    hit = {b: F.when((F.col("_rank") == 1) & (F.col("_d") <= float(b)), 1).otherwise(0) for b in counted}
    out = ranked.groupBy(segment_key, key, "m").agg(
        *[(F.sum(hit[b]) if b in hit else F.max(F.lit(0))).cast("int").alias(f"count_{b:g}m") for b in buffers]
    )
    if drop_empty:
        names = [f"count_{b:g}m" for b in buffers]
        peak = out.agg(*[F.max(n).alias(n) for n in names]).first()
        out = out.drop(*[n for n in names if not peak[n]])
    return out


def interior_counts(
    parcels: DataFrame,
    segments: DataFrame,
    features: DataFrame,
    feature_key: str,
    buffers: list[float] = BUFFERS,
    key: str = "id_parcel",
    snap: float | None = None,
    grid: Grid = Grid(),
    **kw,
) -> DataFrame:
    """Point features of a parcel that are not closer than b to any of its own segments."""
    feats = _snapped(features, feature_key, snap)
    within = sjoin(parcels.select(key, "geometry"), feats, 0.0, grid, **kw).select(key, "_fid")
    near = sjoin(feats, segments.select(key, "geometry"), float(max(buffers)), grid, distance_col="_d", **kw)
    rim = near.groupBy(key, "_fid").agg(F.min("_d").alias("_d"))
    measured = within.join(unbroadcast(rim), [key, "_fid"], "left").withColumn("_d", F.coalesce("_d", F.lit(float("inf"))))
    free = {b: F.col("_d") >= float(b) for b in buffers}
    smallest = min(buffers)
    return (
        measured.where(free[smallest])
        .groupBy(key)
        .agg(*[F.count(F.when(free[b], 1)).cast("int").alias(f"count_{b:g}m") for b in buffers])
    )


def parcel_tree_features(
    boundary_counts: DataFrame,
    adjacency: DataFrame,
    flags: DataFrame,
    uses: list[str],
    interior: DataFrame,
    buffers: list[int] = (4, 8),
    threshold: str = "0.5 < proportion_12m",
    key: str = "id_parcel",
    segment_key: str = "id_boundary",
) -> DataFrame:
    """Per parcel, boundary trees by use, halved on shared boundary, and interior trees."""
    adj = adjacency.withColumn("_f", F.expr(f"CAST({threshold} AS DOUBLE)")).groupBy(segment_key).agg(F.max("_f").alias("bool_adjacency"))
    near = flags.select(segment_key, *[F.col(f"bool_{u}").cast("double").alias(f"bool_{u}") for u in uses])
    table = boundary_counts.join(unbroadcast(adj), segment_key, "left").join(unbroadcast(near), segment_key, "left")
    half = (2 - F.col("bool_adjacency")) / 2
    aggs = []
    for b in buffers:
        n = F.col(f"count_{b}m")
        aggs.append(F.sum(n).cast("int").alias(f"n_boundary_trees_{b}m"))
        aggs.append(F.sum(n * half).alias(f"n_adj_boundary_trees_{b}m"))
        for name in uses:
            aggs.append(F.sum(n * F.col(f"bool_{name}")).cast("int").alias(f"n_{name}_trees_{b}m"))
            aggs.append(F.sum(n * F.col(f"bool_{name}") * half).alias(f"n_adj_{name}_trees_{b}m"))
    inside = interior.select(key, *[F.col(f"count_{b}m").cast("int").alias(f"n_interior_trees_{b}m") for b in buffers])
    out = table.groupBy(key).agg(*aggs).join(unbroadcast(inside), key, "outer").na.fill(0)
    return out.withColumns({f"n_adj_trees_{b}m": F.col(f"n_adj_boundary_trees_{b}m") + F.col(f"n_interior_trees_{b}m") for b in buffers})


def metric_product(
    pairs: DataFrame, key: str, feature_key: str, metrics: dict[str, str], buffers: list[float], distance: str = "distance", once_per_parcel: bool = True
) -> DataFrame:
    """Every metric expression summed over the features within every buffer.

    once_per_parcel counts a feature once per parcel, at its smallest distance;
    otherwise once per boundary row it is near.
    """
    rows = pairs
    if once_per_parcel:
        values = [F.first(F.expr(e)).alias(f"_v{i}") for i, e in enumerate(metrics.values())]
        rows = pairs.groupBy(key, feature_key).agg(F.min(distance).alias(distance), *values)
        cols = {name: F.col(f"_v{i}") for i, name in enumerate(metrics)}
    else:
        cols = {name: F.expr(e) for name, e in metrics.items()}
    aggs = [
        F.coalesce(F.sum(F.when(F.col(distance) <= float(b), v)), F.lit(0)).alias(f"{name}_{b:g}m") for (name, v), b in product(cols.items(), buffers)
    ]
    return rows.groupBy(key).agg(*aggs)


def count_report(pairs: DataFrame, key: str, feature_key: str, buffers: list[float], distance: str = "distance") -> DataFrame:
    """Per buffer, distinct features, feature matches and distinct parcels."""
    bands = F.filter(F.array(*[F.lit(float(b)) for b in buffers]), lambda b: F.col(distance) <= b)
    return (
        pairs.select(key, feature_key, F.explode(bands).alias("buffer"))
        .groupBy("buffer")
        .agg(
            F.count_distinct(feature_key).alias("n_features"),
            F.count("*").alias("n_matches"),
            F.count_distinct(key).alias("n_parcels"),
        )
    )
