"""Assigned habitats against every pair of a candidate and a nearby habitat."""

import itertools
import random

from landgrain.operators import habitats as H

CANDIDATE = "id_parcel long, action_group string, action_habitat string, is_upland boolean, soilscape_habitat_code int, unit int"
NEARBY = "id_parcel long, action_group string, action_habitat_phi string, soilscape_habitat_code_phi int, habitat_name string, distance_threshold int, area double, nearby_rare_habitat boolean"


def low(v):
    return (v is not None, v if v is not None else 0)


def high(v):
    return (v is None, -float(v) if v is not None else 0)


def plain(cands, near):
    """The first pair or default of every parcel and group: its order columns."""
    best = {}
    for c in cands:
        key = (c[0], c[1])
        for n in near:
            if n[:2] != c[:2] or None in key:
                continue
            ma = None if None in (c[2], n[2]) else c[2] == n[2]
            ms = None if None in (c[4], n[3]) else c[4] == n[3]
            if (ma and ms) or c[1] == "SRG":
                row = (high(ma), high(ms), low(n[5]), high(n[7]), high(n[6]), high(None), (c[2] is not None, c[2] or ""), low(c[5]))
                best[key] = min(best.get(key, row), row)
    for key in {c[:2] for c in cands if c[1] == "SRG"}:
        unit, up = min((low(c[5]), c[3]) for c in cands if c[:2] == key)
        found = sorted(((low(n[5]), high(n[6]), n[4]) for n in near if n[0] == key[0]))[:1]
        name = ("upland_" if up else "lowland_") + ("acid_gr" if found and found[0][2] in H.ACID else "meadow")
        row = (high(None), high(None), low(None), high(None), high(None), high(True), (True, name), unit)
        best[key] = min(best.get(key, row), row)
    return best


def test_assignment_is_first_of_all_pairs(spark):
    rnd = random.Random(5)
    some = lambda *v: rnd.choice([*v, None])
    cands, near = [], []
    for p in range(60):
        up, kinds, soils = rnd.random() < 0.5, rnd.sample("abcd", 2), rnd.sample(range(4), 2)
        cands += [(p, rnd.choice(["SRG", "Wetland"]), some(*kinds), up, some(*soils), rnd.randrange(6)) for _ in range(rnd.randrange(1, 8))]
        near += [
            (p, rnd.choice(["SRG", "Wetland"]), some(*"abcd"), some(*range(4)), rnd.choice(["blanket bog", "upland fen", "x"]), some(1000, 3000), float(rnd.randrange(4)), rnd.random() < 0.5)
            for _ in range(rnd.randrange(0, 7))
        ]
    got = H.assign_habitats(spark.createDataFrame(cands, CANDIDATE), spark.createDataFrame(near, NEARBY)).collect()
    rows = {
        (r.id_parcel, r.action_group): (
            high(r.matches_action), high(r.matches_soil), low(r.distance_threshold), high(r.nearby_rare_habitat), high(r.area), high(r.is_default), (r.action_habitat is not None, r.action_habitat or ""), low(r.unit),
        )
        for r in got
    }
    assert len(rows) == len(got) and rows == plain(cands, near)


def test_no_parcel_meets_all_its_habitats(spark):
    cands = spark.range(400).selectExpr("1L AS id_parcel", "'SRG' AS action_group", "concat('a', id % 2) AS action_habitat", "true AS is_upland", "cast(id % 3 AS int) AS soilscape_habitat_code", "cast(id AS int) AS unit")
    near = spark.range(400).selectExpr(
        "1L AS id_parcel", "'SRG' AS action_group", "concat('a', id % 2) AS action_habitat_phi", "cast(id % 3 AS int) AS soilscape_habitat_code_phi", "concat('n', id) AS habitat_name",
        "1000 AS distance_threshold", "double(id) AS area", "false AS nearby_rare_habitat",
    )
    seen = []
    hold, H.ranking.best_rows = H.ranking.best_rows, lambda df, *a: seen.append(df.count()) or hold(df, *a)
    try:
        H.assign_habitats(cands, near)
    finally:
        H.ranking.best_rows = hold
    assert max(seen) <= 400
