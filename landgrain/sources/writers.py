"""Writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.functions import codecs as C
from landgrain.functions import geometry as G
from landgrain.operators.ranking import batches
from landgrain.operators.spatial_join import small_enough


def encode_geometry(df: DataFrame) -> DataFrame:
    """Geometry columns as well-known binary, the form kept on disk."""
    shape = df.sparkSession.range(0).select(G.empty().alias("g")).schema["g"].dataType.simpleString()
    for f in df.schema:
        if f.dataType.simpleString() == shape:
            df = df.withColumn(f.name, C.to_wkb(f.name))
    return df


def sliced(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The rows dealt out to tasks by partition value, a value with many rows to as many tasks as it needs.

    The rows of each value are counted first; its number of slices is its count over `rows`.
    """
    sizes = df.groupBy(*by).agg(F.ceil(F.count("*") / rows).cast("int").alias("_slices"))
    sizes = sizes.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    row = F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")], F.monotonically_increasing_id())
    dealt = df.withColumn("_row", row).join(sizes, same).withColumn("_slice", F.pmod("_row", "_slices"))
    return dealt.repartition(*by, "_slice").select(df.columns)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = (), rows: int = 1_000_000) -> None:
    """Replace a Parquet table; every partition carries the same schema, and no file has more than `rows` rows.

    Copies of one row are dealt out like other rows, so no value is bound to one task.
    """
    out = encode_geometry(df)
    if partition_by:
        out = sliced(out, list(partition_by), rows)
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_batches(df: DataFrame, path: str, keys: list[str], order: str, tie: str, size: int = 500) -> None:
    """Partitions by key and by batches of `size` rows within a key."""
    batches(df, keys, order, tie, size).write.mode("overwrite").partitionBy(*keys, "batch").parquet(path)


def export(df: DataFrame, path: str, format: str = "csv", single: bool = True, most: int = 1_000_000) -> None:
    """One file in a folder of its own; `single=False` writes one file per partition.

    A single file passes through one task, so it is for results of at most `most` rows; more raise an
    error before anything is written.  The rows are made by all tasks and only then brought together.
    """
    out = encode_geometry(df) if format == "parquet" else df
    if single:
        if not small_enough(out, most):
            raise ValueError(f"more than {most} rows for one file: write them with single=False")
        out = out.repartition(1)
    writer = out.write.mode("overwrite")
    (writer.option("header", True) if format == "csv" else writer).format(format).save(path)


def export_split(df: DataFrame, path: str, by: list[str], format: str = "csv") -> None:
    """One folder per combination of scenario values."""
    df.write.mode("overwrite").option("header", True).partitionBy(*by).format(format).save(path)
