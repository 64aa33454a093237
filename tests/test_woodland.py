"""Which woodland scenarios count."""

from landgrain.operators import habitats as H


def test_usable_scenarios(spark):
    """Signed sums over periods, each column by itself; rows without a species go afterwards."""
    rows = [
        ("a", "w", 1, 2.0, 0.0, "oak", None), ("a", "w", 2, -2.0, 0.0, "oak", None),  # sums to zero
        ("b", "w", 1, 1.0, -1.0, None, "ash"), ("b", "w", 2, 0.0, 0.0, None, None),  # columns do not cancel; one row without species
        ("c", "w", 1, None, None, "oak", None),  # no values
        ("d", "w", 1, None, 0.1, "oak", None), ("d", "v", 1, 0.0, 0.0, "oak", None),  # per type
        ("e", "w", 1, 0.1, 0.0, "oak", None), ("e", "w", 2, 0.2, 0.0, "oak", None), ("e", "w", 3, -0.3, 0.0, "oak", None),  # zero but for rounding
    ]
    df = spark.createDataFrame(rows, "tile string, woodland_type string, period int, tree double, soil double, species_1 string, species_2 string")
    got = H.usable_scenarios(df, "tile", ["woodland_type", "period"], ["tree", "soil"], ["species_1", "species_2"]).collect()
    assert sorted((r.tile, r.woodland_type, r.period) for r in got) == [("b", "w", 1), ("d", "w", 1)]


def test_partitions_follow_the_joined_rows(spark, monkeypatch):
    """Few small rows that the join multiplies are dealt to as many tasks as their products need."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(H, "TASK_ROWS", 2_000, raising=False)
    parcels = spark.range(600).selectExpr("id AS id_parcel", "id % 3 AS tile", "1.0D AS area")
    scenarios = spark.range(300).selectExpr("id % 3 AS tile", "id AS s")
    joined = H._by_tile(parcels, scenarios, "tile")
    assert joined.count() == 600 * 100 and joined.select("id_parcel", "s").distinct().count() == 600 * 100
    loads = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in loads) <= 3 * 2_000
