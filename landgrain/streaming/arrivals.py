"""Features that arrive as files, joined to a fixed parcel table.

Each micro-batch goes through the same spatial join as a full table, and its
matches are written under the batch number, so a batch that is retried after a
failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from landgrain.operators.spatial_join import Grid, sjoin


def join_arrivals(
    spark: SparkSession, path: str, schema, shape, parcels: DataFrame, out: str, checkpoint: str, distance: float = 0.0, grid: Grid = Grid(), columns: list[str] | None = None
) -> StreamingQuery:
    """Start a stream over Parquet files in `path`; `shape` turns a batch into rows with a geometry."""

    def write(batch: DataFrame, number: int) -> None:
        matched = sjoin(parcels, shape(batch), distance, grid)
        kept = matched.select(*columns) if columns else matched
        kept.write.mode("overwrite").parquet(f"{out}/batch={number}")

    arriving = spark.readStream.schema(schema).parquet(path)
    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
