"""Joins whose sides grow by expressions are not broadcast, however small their files are."""

import pytest

from landgrain import plans
from landgrain.functions import geometry as G
from landgrain.operators import spatial_join as SJ


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["O3_boundary_hedges", "O7_boundary_merger", "O8_parcel_tree_features", "O14_area_within_round", "O15_divide_by_use", "O16_allocate_by_priority", "H14_boundary_uses"])
def test_sides_made_by_generators_are_sorted(spark, sf_dir, name):
    assert "Broadcast" not in physical(plans.QUERIES[name](spark, sf_dir))


def test_lineage_steps_are_sorted(spark, sf_dir):
    from landgrain.plans.datasets import tree
    from landgrain.sources import catalogue

    seen = []
    hold, catalogue.durable = catalogue.durable, lambda df: seen.append(physical(df)) or hold(df)
    try:
        catalogue.lineage(tree(spark, sf_dir)[1])
    finally:
        catalogue.durable = hold
    assert seen and not any("Broadcast" in p for p in seen)


def test_small_side_meets_on_cells(spark):
    left = spark.range(50).selectExpr("id AS a", f"{G.box_sql('id * 7', 'id * 3', 'id * 7 + 5', 'id * 3 + 5')} AS geometry")
    right = spark.range(9).selectExpr("id AS b", f"{G.box_sql('id * 40', 'id * 15', 'id * 40 + 20', 'id * 15 + 300')} AS geometry")
    small = SJ.sjoin_small(left, right, grid=SJ.Grid(20.0))
    assert "NestedLoop" not in physical(small) and "BroadcastHashJoin" in physical(small)
    want = sorted(map(tuple, SJ.sjoin(left, right, grid=SJ.Grid(20.0)).select("a", "b").collect()))
    assert want and sorted(map(tuple, small.select("a", "b").collect())) == want


def test_wildcard_lookup_has_each_rule_once(spark, sf_dir):
    assert physical(plans.QUERIES["J19_wildcard_match"](spark, sf_dir)).count("HashAggregate") >= 3


@pytest.mark.parametrize("name", ["O16_allocate_by_priority", "O3_boundary_hedges", "O7_boundary_merger", "O7_boundary_merger_90p12m"])
def test_no_side_is_broadcast_however_small_the_files_look(spark, sf_dir, name):
    """Even a threshold above every estimate leaves these joins sorted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        plan = physical(plans.QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_a_pair_of_edges_meets_in_one_cell(spark, sf_dir, monkeypatch):
    from landgrain.operators import linear
    from landgrain.plans import fixtures

    met, found = [], linear.candidates
    monkeypatch.setattr(linear, "candidates", lambda *a, **kw: met.append(found(*a, **kw)) or met[-1])
    parcels = fixtures.layer(spark, sf_dir, "parcels").select("id_parcel", "geometry").limit(300)
    segments = fixtures.segments(spark, sf_dir).join(parcels.select("id_parcel"), "id_parcel")
    linear.boundary_adjacency(parcels, segments, [2, 12], grid=fixtures.CELL)
    pairs = met[0].selectExpr("_seg", "_edge", "id_parcel_right", "_area", "_fx0", "_fy0", "_fx1", "_fy1")
    assert pairs.count() == pairs.distinct().count() > 1000
