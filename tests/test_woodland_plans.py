"""The scenarios of a parcel's tiles are aggregated where the parcel is."""

import re

from landgrain import plans


def test_parcel_scenarios_are_not_shuffled(spark, sf_dir):
    for name in ("H7_woodland_species", "H7_woodland_carbon"):
        plan = plans.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"hashpartitioning\((id_parcel[^)]*)\)", plan)
        assert keys and all(re.fullmatch(r"id_parcel#\d+L?, \d+", k) for k in keys), keys
