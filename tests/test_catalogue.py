import time

import pytest
from pyspark.sql import functions as F

from landgrain.operators.tables import pivot_long, pivot_wide
from landgrain.sources.catalogue import Catalogue, Dataset
from landgrain.sources.rules import Model, Rule, RuleError, merge_validated, require


def build(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(10).selectExpr("id", "id * 2.0D AS val").write.mode("overwrite").parquet(src)
    model = Model({"id": Rule("bigint", nullable=False, unique=True), "value": Rule("double", ge=0, alias="val")})
    times10 = lambda df: df.withColumn("value", F.col("value") * 10)
    return src, Catalogue(
        spark,
        str(tmp_path / "lake"),
        [
            Dataset("first", kind="source", level="bronze", path=src, model=model),
            Dataset("second", depends=("first",), build=times10),
            Dataset("third", depends=("second",), build=times10),
        ],
    )


def test_refresh_cascades(spark, tmp_path):
    src, cat = build(spark, tmp_path)
    assert cat.refresh("2024_01_01") == ["first", "second", "third"]
    assert cat.refresh("2024_01_02") == []
    assert cat.read("third").agg(F.max("value")).first()[0] == 1800.0
    before = {r["name"]: r["hash"] for r in cat.hashes().collect()}
    time.sleep(1.1)
    spark.range(5).selectExpr("id", "id * 3.0D AS val").write.mode("overwrite").parquet(src)
    after = {r["name"]: r["hash"] for r in cat.hashes().collect()}
    assert all(before[n] != after[n] for n in before)
    assert cat.refresh("2024_01_03") == ["first", "second", "third"]
    assert cat.read("third").count() == 5
    assert cat.publish(str(tmp_path / "out")) == ["second", "third"]
    assert cat.publish(str(tmp_path / "out")) == []
    assert {(r.name, r.level) for r in cat.levels().collect()} == {("first", 0), ("second", 1), ("third", 2)}


def test_rules(spark):
    df = spark.createDataFrame([(1, "x"), (1, None)], "id int, name string")
    with pytest.raises(RuleError):
        require(df, Model({"id": Rule(unique=True)}))
    with pytest.raises(RuleError):
        require(df, Model({"name": Rule(nullable=False)}))
    with pytest.raises(RuleError):
        merge_validated(df, df, ["id"], expect="1:1")
    assert require(df, Model({"id": Rule("bigint", ge=1)})).dtypes[0] == ("id", "bigint")


def test_pivot_round_trip(spark):
    rows = [(1, 4, 5), (2, 9, 10), (3, 3, 3), (4, 20, 8)]
    df = spark.createDataFrame(rows, "id int, x int, y int")
    wide = pivot_wide(pivot_long(df, ["x", "y"])).select("id", "x", "y")
    assert sorted(map(tuple, wide.collect())) == rows


def test_globs_keep_their_files_and_cycles_are_errors(spark, tmp_path):
    spark.range(3).selectExpr("id", "1 AS a").write.parquet(str(tmp_path / "in1"))
    spark.range(2).selectExpr("id", "2 AS b").write.parquet(str(tmp_path / "in2"))
    cat = Catalogue(spark, str(tmp_path / "lake"), [Dataset("all", kind="glob", path=str(tmp_path / "in*"))])
    assert set(cat._ingest(cat.datasets["all"]).columns) == {"id", "a", "b", "_path"}
    with pytest.raises(ValueError, match="cycle"):
        Catalogue(spark, str(tmp_path / "x"), [Dataset("p", depends=("q",)), Dataset("q", depends=("p",))])._order()
