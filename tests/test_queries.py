"""Registered queries against their check SQL; FULL_CHECK=1 runs every one."""

import os

import pytest

from compare import connect, differences

SAMPLE = [
    "J1_intersects", "J1_intersects_diamond", "J4_block_envelopes", "J5_adaptive_cells", "J6_knn_per_class", "J8_adjacency", "J9_spatial_anti",
    "O2_parcel_proportion", "O3_boundary_water", "O4_nearest_boundary_counts", "O5_interior_counts", "O9_area_within_distances", "O12_dominant_class",
    "P16_outlier_trim", "A9_pivot_wide", "A14_subtotals", "A22_period_rollup", "W5_quintile_many_ties", "W9_batches", "W10_average_rank", "L6_head_and_tail",
    "N4_combine_long", "F3_clean_names", "F14_tag_map", "F22_winter_season", "G1_area", "G8_lead_segments", "G17_grid_names", "G24_pointify",
    "R7_clearest_composite", "R8_snow_free_composite", "R11_fill_nearest", "H3_assigned_habitats", "H6_erosion_scores", "S10_partitioned_sink", "D3_freshness", "D6_validation_report", "U2_iterator_function",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def _names():
    from landgrain import plans

    return list(plans.QUERIES) if os.environ.get("FULL_CHECK") else SAMPLE


@pytest.mark.parametrize("name", _names())
def test_query(spark, duck, sf_dir, name):
    from landgrain import plans

    got = plans.QUERIES[name](spark, sf_dir).toPandas()
    if name in plans.CHECKS:
        assert differences(got, duck.execute(plans.CHECKS[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["id_parcel", "class", "proportion"]
