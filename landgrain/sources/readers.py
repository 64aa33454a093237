"""Reading tables into DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrain.functions import codecs as C

SRID = 27700


def decode_geometry(df: DataFrame, column: str = "geometry", srid: int = SRID) -> DataFrame:
    """A WKB or WKT column to a geometry column; the reference system is kept as column metadata."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BinaryType):
        df = df.withColumn(column, C.from_wkb(column))
    elif isinstance(kind, T.StringType):
        df = df.withColumn(column, C.from_wkt(column))
    return df.withMetadata(column, {"srid": srid})


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None, geometry: str | None = "geometry", columns: list[str] | None = None, where: str | Column | None = None) -> DataFrame:
    """Parquet scan; column list and filter reach the scan, geometry is decoded."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    df = df.where(where) if where is not None else df
    df = df.select(*columns) if columns else df
    return decode_geometry(df, geometry) if geometry and geometry in df.columns else df


def read_drifting(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files whose schemas disagree, united by name with absent columns null.

    Columns whose types differ are widened: integers to long, numbers to
    double, anything else to string.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except AnalysisException:
        pass
    except Exception as error:  # the merge may fail only when the footers are read
        if "SCHEMA" not in str(error).upper():
            raise
    frames = [spark.read.parquet(p) for p in paths]
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema:
            types[f.name] = _wider(types[f.name], f.dataType) if f.name in types else f.dataType
    cast = [df.select(*[F.col(f.name).cast(types[f.name]) for f in df.schema]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: CSV with a header; without a schema the types are inferred, which costs a pass."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_glob(spark: SparkSession, pattern: str, format: str = "parquet", **options) -> DataFrame:
    """Every file a pattern matches, with the file it came from in `_path`."""
    df = spark.read.format(format).options(**{"mergeSchema": "true", **options} if format == "parquet" else options).load(pattern)
    return df.select("*", F.col("_metadata.file_path").alias("_path"))


def path_columns(path) -> dict[str, Column]:
    """Woodland type and climate pathway from `.../{type}/{10 chars}{name}{7 chars}.csv`-like paths.

    The folder above the file is the type; the pathway is the two digits before the extension.
    """
    p = F.col(path) if isinstance(path, str) else path
    pieces = F.split(p, "/")
    name = F.element_at(pieces, -1)
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    return {"woodland_type": F.try_element_at(pieces, F.lit(-2)), "rcp": F.right(stem, F.lit(2))}


def read_layers(spark: SparkSession, layers: dict[str, str], format: str = "parquet") -> DataFrame:
    """Several layers in one table with a `layer` column."""
    frames = [spark.read.format(format).load(p).withColumn("layer", F.lit(n)) for n, p in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_geojson_lines(spark: SparkSession, path: str, properties: T.StructType | str) -> DataFrame:
    """One GeoJSON feature per line."""
    raw = spark.read.text(path)
    shape = F.get_json_object("value", "$.geometry")
    props = F.from_json(F.get_json_object("value", "$.properties"), properties if isinstance(properties, str) else properties.simpleString())
    return raw.select(props.alias("p"), C.from_geojson(shape).alias("geometry")).select("p.*", "geometry")
