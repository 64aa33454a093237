"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "J1_intersects",
    "J2_within_distance",
    "J6_knn_per_class",
    "J1_intersects_diamond",
    "J2_within_distance_diamond",
    "J8_adjacency",
    "J9_spatial_anti",
    "J10_contains",
    "O2_parcel_proportion",
    "O3_boundary_hedges",
    "O4_nearest_boundary_counts",
    "O9_area_within_distances",
    "O12_dominant_class",
    "O19_pair_overlap",
    "O19_pair_overlap_diamond",
    "A1_group_measures",
    "A3_weighted_means",
    "A9_pivot_wide",
    "W1_row_number_top",
    "W5_global_quintile",
    "R7_clearest_composite",
    "R13_zonal_bare_soil",
    "H4_existing_habitats",
]


def main() -> None:
    from landgrain import plans
    from landgrain.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", cpus=cpus)
    plans.QUERIES["A1_group_measures"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the workers
    seconds = {}
    for name in names:
        start = time.time()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
