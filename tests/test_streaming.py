from landgrain.plans.fixtures import CELL, layer
from landgrain.functions import geometry as G
from landgrain.operators.spatial_join import sjoin
from landgrain.streaming.arrivals import join_arrivals


def test_arrivals_equal_the_whole(spark, tmp_path, sf_dir):
    trees = layer(spark, sf_dir, "trees").select("k", "x0", "y0")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in (0, 1):
        trees.where(f"k % 2 = {i}").write.mode("append").parquet(src)
    parcels = layer(spark, sf_dir, "parcels").select("id_parcel", "geometry")

    def shape(df):
        return df.selectExpr("k", f"{G.point_sql('x0', 'y0')} AS geometry")

    join_arrivals(spark, src, trees.schema, shape, parcels, out, str(tmp_path / "cp"), grid=CELL, columns=["id_parcel", "k"]).awaitTermination()
    got = sorted((r.id_parcel, r.k) for r in spark.read.parquet(out).collect())
    whole = sjoin(parcels, shape(trees), grid=CELL)
    assert got == sorted((r.id_parcel, r.k) for r in whole.select("id_parcel", "k").collect())
