"""Boundary near features that equal their envelopes: a row per feature, the same intervals as by edges."""

import re

from pyspark.sql import functions as F

from landgrain import plans
from landgrain.functions import geometry as G
from landgrain.operators import linear
from landgrain.operators import spatial_join as SJ


def layers(spark):
    """Slanted, axis-parallel and zero-length segments; boxes, axis-parallel lines and points, each twice."""
    lines = spark.range(60).selectExpr("id AS id_boundary", "'P' || id % 7 AS own", f"{G.segment_sql('id * 3', '(id * 5) % 40', 'id * 3 + (id % 4) * 9', '(id * 5) % 40 + (id % 3) * 11')} AS geometry")
    feats = spark.range(50).selectExpr("'P' || id % 7 AS id", "id % 3 AS class", f"{G.box_sql('id * 4', '(id * 7) % 45', 'id * 4 + 6', '(id * 7) % 45 + 3 + id % 5')} AS geometry")
    walls = spark.range(30).selectExpr("'P' || id % 7 AS id", "id % 3 AS class", f"{G.segment_sql('id * 6', '(id * 11) % 50', 'id * 6 + (id % 3) * 4', '(id * 11) % 50')} AS geometry")
    every = feats.unionAll(walls).unionAll(spark.range(9).selectExpr("'Q' AS id", "id % 3 AS class", f"{G.point_sql('id * 20', 'id * 5')} AS geometry"))
    return lines, every.unionAll(every)


def spans(lines, feats):
    out = linear.buffer_spans(lines, feats, ["class"], [0.0, 2.0, 7.5], grid=SJ.Grid(25.0), exclude=("own", "id"))
    # an edge without length has nothing to measure, and by edges it is not near a point
    rows = out.where("run > 0").select("id_boundary", "class", "buffer", F.round("t0", 9).alias("t0"), F.round("t1", 9).alias("t1"), F.round("run", 9).alias("run")).collect()
    return sorted(tuple(r) for r in rows)


def test_boxes_have_the_intervals_of_their_edges(spark, monkeypatch):
    lines, feats = layers(spark)
    whole = spans(lines, feats)
    monkeypatch.setattr(linear, "only_boxes", lambda df: False)
    by_edges = spans(lines, feats)
    assert len(whole) > 200 and {r[2] for r in whole} == {0.0, 2.0, 7.5}
    assert [r[:3] for r in whole] == [r[:3] for r in by_edges]
    assert all(abs(a - b) < 1e-6 for x, y in zip(whole, by_edges) for a, b in zip(x[3:], y[3:]))


def test_a_box_meets_an_edge_once(spark, monkeypatch):
    met, found = [], linear.candidates
    monkeypatch.setattr(linear, "candidates", lambda *a, **kw: met.append(found(*a, **kw)) or met[-1])
    lines = spark.createDataFrame([(1, "a")], "id_boundary long, own string").select("*", G.segment(F.lit(0), F.lit(12), F.lit(20), F.lit(12)).alias("geometry"))
    box = spark.createDataFrame([("b", 1)] * 3, "id string, class int").select("*", G.rectangle(F.lit(2), F.lit(0), F.lit(9), F.lit(10)).alias("geometry"))
    out = linear.buffer_spans(lines, box, ["class"], [5.0], grid=SJ.Grid(200.0)).collect()
    assert met[0].count() == 1 and len(out) == 1


def shuffles(spark, sf_dir, name):
    plan = plans.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Reused)Exchange \w", plan))


def test_intervals_are_shuffled_once(spark, sf_dir):
    """The spans of an edge go from the cells to their segments, and stay there."""
    assert shuffles(spark, sf_dir, "O3_boundary_adjacency") <= 9
    assert shuffles(spark, sf_dir, "O7_boundary_merger") <= 10
    assert shuffles(spark, sf_dir, "O7_boundary_merger_90p12m") <= 10


def test_trees_are_listed_around_the_segments(spark, monkeypatch):
    """The many segments are the side that is listed without the distance."""
    from landgrain.operators import tally

    sides, join = [], tally.sjoin
    monkeypatch.setattr(tally, "sjoin", lambda left, right, *a, **kw: sides.append(left.columns) or join(left, right, *a, **kw))
    lines, feats = layers(spark)
    trees = spark.range(30).selectExpr("id AS fid", f"{G.point_sql('id * 6', 'id')} AS geometry")
    named = lines.selectExpr("id_boundary", "own AS id_parcel", "1.0D AS m", "geometry")
    out = tally.nearest_segment_counts(named, trees, "fid", [2, 24], grid=SJ.Grid(25.0))
    assert sides == [["_fid", "geometry"]] and out.agg(F.sum("count_24m")).first()[0] > 30


def test_features_of_parcels_are_not_shuffled_to_drop_copies(spark, monkeypatch):
    """O1 drops copies where a cell's rows meet, and a box by itself needs no kernel."""
    from landgrain.operators import overlap

    seen, join = [], overlap.sjoin
    monkeypatch.setattr(overlap, "sjoin", lambda *a, **kw: seen.append(kw.get("copies")) or join(*a, **kw))
    parcels = spark.range(1).select(F.lit("a").alias("id_parcel"), G.rectangle(F.lit(0), F.lit(0), F.lit(9), F.lit(9)).alias("geometry"))
    feats = spark.range(3).select(F.lit("x").alias("class"), G.rectangle(F.lit(2), F.lit(3), F.lit(6), F.lit(8)).alias("geometry"))
    got = overlap.join_parcels(parcels, feats, ["class"], grid=SJ.Grid(50.0)).select(G.area("geometry_right").alias("a")).collect()
    assert seen == [True] and [r.a for r in got] == [20.0]
