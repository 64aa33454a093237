"""Exact quantiles, sized writes and table functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgrain.functions import kernels as K
from landgrain.functions.codecs import from_wkt
from landgrain.operators import linear, quantiles
from landgrain.sources import writers


@pytest.mark.parametrize("distinct, buckets", [(10_000, 1024), (5, 4), (1, 2)])
def test_quantiles_equal_sorting(spark, monkeypatch, distinct, buckets):
    monkeypatch.setattr(quantiles, "DISTINCT", distinct)
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=300), "b": np.repeat([1.0, 2.0, 5.0], [40, 1, 9]), "c": np.append(rng.uniform(0, 1, 60), [1e12, -1e9]), "d": np.array([7.5]), None: rng.integers(0, 9, 50) * 1.0, "e": np.array([])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"q0": 0.0, "q25": 0.25, "half": 0.5, "q90": 0.9, "q1": 1.0}
    got = {r["k"]: [r[c] for c in wanted] for r in quantiles.quantiles(df, ["k"], "v", wanted).collect()}
    assert got.keys() == {k for k, vs in groups.items() if len(vs)}
    for k, values in got.items():
        assert values == pytest.approx([np.quantile(groups[k], p) for p in wanted.values()], rel=1e-12)
    whole = quantiles.quantiles(df, [], "v", {"half": 0.5}).first()["half"]
    assert whole == pytest.approx(np.median(np.concatenate(list(groups.values()))))
    beside = quantiles.with_quantiles(df.groupBy("k").agg(F.count("*").alias("n")), df, ["k"], "v", {"half": 0.5}).collect()
    assert len(beside) == 6 and {r["k"]: r["half"] for r in beside}["e"] is None
    assert quantiles.quantiles(df.limit(0), ["k"], "v", wanted).count() == 0


def test_a_large_group_is_not_gathered(spark):
    df = spark.range(300_000).select((F.col("id") % 3 == 0).alias("k"), (F.hash("id") / 7).alias("v"))
    got = {r["k"]: r["m"] for r in quantiles.quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}


def test_writes_sized_by_the_data(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").when(F.col("id") < 990, "cold").alias("kind"), F.lit(1).alias("same"))
    writers.write_parquet(df, str(tmp_path / "t"), ["kind"], rows=100)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {r["kind"]: r["count"] for r in back.groupBy("kind").count().collect()} == {"hot": 900, "cold": 90, None: 10}
    per_file = back.groupBy(F.input_file_name().alias("f"), "kind").count().collect()
    assert max(r["count"] for r in per_file) <= 100 and sum(r["kind"] == "hot" for r in per_file) >= 9


def test_single_file_has_a_bound(spark, tmp_path):
    writers.export(spark.range(20).repartition(4), str(tmp_path / "one"), most=20)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    with pytest.raises(ValueError, match="more than 19 rows"):
        writers.export(spark.range(20), str(tmp_path / "two"), most=19)
    assert not (tmp_path / "two").exists()


def test_table_function_numbers_pieces(spark):
    at = np.linspace(0, 2 * np.pi, 40, endpoint=False)
    ring = np.column_stack([np.cos(at) * 10, np.sin(at) * 10])
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in np.vstack([ring, ring[:1]]).tolist()) + "))"
    shapes = spark.range(6).select((F.col("id") % 2).alias("k"), "id", from_wkt(F.lit(wkt)).alias("geometry"))
    got = linear.cut_pieces(shapes, "k", "id", 12).orderBy("id", "piece").collect()
    n = len(K.halve_until([(2, [np.vstack([ring, ring[:1]])])], 12))
    assert n > 3 and [(r["id"], r["piece"]) for r in got] == [(k, p) for k in "01" for p in range(3 * n)]
    assert sum(r["area"] for r in got) == pytest.approx(6 * K.signed_area(np.vstack([ring, ring[:1]]))) and max(r["vertices"] for r in got) <= 12
    assert linear.cut_pieces(shapes.limit(0), "k", "id").count() == 0
    with pytest.raises(ValueError):
        linear.cut_pieces(shapes, "k", "id", 4)


def test_table_function_gets_sizes_of_pieces(spark):
    """Rings are cut by the batch; holes, parts and empty shapes come out as the kernel cuts them."""
    at = np.linspace(0, 2 * np.pi, 30, endpoint=False)
    ring = ", ".join(f"{float(10 * np.cos(a))!r} {float(10 * np.sin(a))!r}" for a in [*at, 0.0])
    wkts = [f"POLYGON (({ring}))", f"POLYGON (({ring}), (-1 -1, -1 1, 1 1, 1 -1, -1 -1))", f"MULTIPOLYGON ((({ring})), ((40 0, 50 0, 50 9, 40 0)))", "POLYGON EMPTY", "POLYGON ((0 0, 4 0, 4 3, 0 0))"]
    shapes = spark.createDataFrame([*enumerate(wkts)], "k int, wkt string").select("k", F.lit(0).alias("n"), from_wkt("wkt").alias("geometry"))
    out = linear.cut_pieces(shapes, "k", "n", 12)
    want = []
    for k, row in enumerate(shapes.orderBy("k").collect()):
        parts = [(p["dim"], [np.array([(v["x"], v["y"]) for v in r]) for r in p["rings"]]) for p in row["geometry"]["parts"]]
        want += [(str(k), j, K.count_vertices(c), pytest.approx(K.parts_area(c))) for j, c in enumerate(K.halve_until(parts, 12) if parts else ())]
    assert sorted(map(tuple, out.collect())) == want
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
