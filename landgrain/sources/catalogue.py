"""Named datasets with dependencies, version hashes and incremental refresh.

Definitions are code.  What exists on storage, how old it is and what is stale
are tables, worked out with DataFrame programs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from landgrain.functions.text import short_hash
from landgrain.operators.spatial_join import durable, unbroadcast
from landgrain.operators.tables import rename_to_model
from landgrain.sources import writers
from landgrain.sources.readers import decode_geometry, read_glob, read_parquet
from landgrain.sources.rules import Model, require


@dataclass(frozen=True)
class Dataset:
    """kind is source, glob or derived; a derived one has a function of its dependencies' tables."""

    name: str
    kind: str = "derived"
    level: str = "silver"
    source: str = ""
    restricted: bool = False
    path: str | None = None
    format: str = "parquet"
    depends: tuple[str, ...] = ()
    build: Callable[..., DataFrame] | None = None
    model: Model = field(default_factory=Model)
    partition_by: tuple[str, ...] = ()
    version: str = ""


# The shape of a materialised table's folder name, {name}-{date}-{hash}.
FOLDER = r"^(.+)-(\d{4}_\d{2}_\d{2})-([0-9a-f]{8})(?:\.\w+)?$"


class Catalogue:
    def __init__(self, spark: SparkSession, root: str, datasets: list[Dataset]):
        self.spark, self.root = spark, root.rstrip("/")
        self.datasets = {d.name: d for d in datasets}

    # -- D1: tables about the catalogue ------------------------------------

    def table(self) -> DataFrame:
        rows = [(d.name, d.kind, d.level, d.source, d.restricted, list(d.depends), d.path, d.version) for d in self.datasets.values()]
        return self.spark.createDataFrame(
            rows,
            "name string, kind string, level string, source string, restricted boolean, depends array<string>, path string, version string",
        )

    def edges(self) -> DataFrame:
        return self.table().select("name", F.posexplode("depends").alias("pos", "parent"))

    # -- D2: lineage -----------------------------------------------------------

    def lineage(self) -> DataFrame:
        """Every (name, ancestor) with the longest path between them."""
        return lineage(self.edges())

    def levels(self) -> DataFrame:
        return build_levels(self.table().select("name"), self.edges())

    # -- D3: what is on storage --------------------------------------------------

    def listing(self) -> DataFrame:
        """Materialised tables: (name, date, hash, path, modified), one row per folder."""
        return newest_files(files(self.spark, self.root))

    # -- D4: version hashes ------------------------------------------------------

    def hashes(self) -> DataFrame:
        """(name, hash) of every dataset, sources from their files, the rest level by level."""
        known = None
        for d in self.datasets.values():
            if d.kind != "derived":
                one = source_hash(self.spark, d)
                known = one if known is None else known.unionAll(one)
        table, edges = self.table().select("name", "version"), self.edges()
        return derive_hashes(known, table, edges, self.levels())

    def stale(self) -> DataFrame:
        """Derived and source datasets with no table carrying their current hash."""
        return self.hashes().join(self.listing().select("name", "hash"), ["name", "hash"], "left_anti")

    # -- D5: refresh ---------------------------------------------------------------

    def refresh(self, date: str) -> list[str]:
        """Rebuild stale datasets in dependency order; returns their names."""
        current = {r["name"]: r["hash"] for r in self.hashes().collect()}
        stale = {r["name"] for r in self.stale().collect()}
        done = []
        for name in self._order():
            if name not in stale:
                continue
            d = self.datasets[name]
            if d.kind == "derived":
                df = d.build(*[self.read(p) for p in d.depends])
            else:
                df = rename_to_model(self._ingest(d), d.model.aliases)
            df = require(df, d.model)
            writers.write_parquet(df, f"{self.root}/{name}-{date}-{current[name]}.parquet", list(d.partition_by))
            done.append(name)
        return done

    def _ingest(self, d: Dataset) -> DataFrame:
        """The raw rows: globs keep the file they came from and are united by name, geometry is decoded."""
        if d.kind == "glob":
            df = read_glob(self.spark, d.path, d.format, **({"mergeSchema": True} if d.format == "parquet" else {"header": True}))
        else:
            df = self.spark.read.format(d.format).options(header=True).load(d.path)
        held = dict(df.dtypes).get("geometry")
        return decode_geometry(df) if held in ("binary", "string") else df

    def _order(self) -> list[str]:
        """Names, dependencies first; a cycle is an error."""
        sorter = TopologicalSorter({n: d.depends for n, d in self.datasets.items()})
        try:
            return list(sorter.static_order())
        except CycleError as e:
            raise ValueError(f"dependencies form a cycle: {e.args[1]}") from None

    def read(self, name: str, **kw) -> DataFrame:
        """The newest table of a dataset."""
        newest = self.listing().where(F.col("name") == name).orderBy(F.col("date").desc(), F.col("modified").desc()).first()
        if newest is None:
            raise FileNotFoundError(name)
        return read_parquet(self.spark, newest.path, **kw)

    # -- S14: publishing ---------------------------------------------------------------

    def publish(self, target: str) -> list[str]:
        """Copy fresh, unrestricted, non-geometry derived tables that the target lacks, and refresh their `-latest` copies."""
        here = self.listing().join(self.hashes(), ["name", "hash"], "left_semi")
        open_ones = self.table().where("kind = 'derived' AND NOT restricted").select("name")
        fresh = here.join(open_ones, "name", "left_semi")
        there = newest_files(files(self.spark, target)).select("name", "hash")
        done = []
        for row in fresh.join(there, ["name", "hash"], "left_anti").orderBy("name").collect():
            df = self.spark.read.parquet(row.path)
            if "geometry" in df.columns:
                continue
            df.write.mode("overwrite").parquet(f"{target}/{row.path.rsplit('/', 1)[-1]}")
            df.write.mode("overwrite").parquet(f"{target}/{row['name']}-latest.parquet")
            done.append(row["name"])
        return done


def files(spark: SparkSession, root: str) -> DataFrame:
    """Data files under a folder with modification times, listed by the file source without reading them."""
    schema = "path string, modificationTime timestamp, length long"
    probe = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = probe.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(probe):
        return spark.createDataFrame([], schema)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listed.select("path", "modificationTime", "length")


def newest_files(listing: DataFrame) -> DataFrame:
    """D3: folders named {name}-{date}-{hash}, with their latest modification."""
    folder = F.regexp_extract("path", r"^(.*/[^/]+-\d{4}_\d{2}_\d{2}-[0-9a-f]{8}(?:\.\w+)?)(?:/.*)?$", 1)
    named = listing.select(folder.alias("path"), "modificationTime").where("path != ''")
    leaf = F.element_at(F.split("path", "/"), -1)
    return (
        named.groupBy("path")
        .agg(F.max("modificationTime").alias("modified"))
        .select(
            F.regexp_extract(leaf, FOLDER, 1).alias("name"),
            F.regexp_extract(leaf, FOLDER, 2).alias("date"),
            F.regexp_extract(leaf, FOLDER, 3).alias("hash"),
            "path",
            "modified",
        )
    )


def freshness(listing: DataFrame, hashes: DataFrame) -> DataFrame:
    """D3: per dataset its newest table and whether that carries the current hash."""
    newest = listing.withColumn("_rn", F.row_number().over(W.partitionBy("name").orderBy(F.col("date").desc(), F.col("modified").desc())))
    newest = newest.where("_rn = 1").select("name", "date", F.col("hash").alias("found"), "path")
    matching = listing.join(hashes, ["name", "hash"], "left_semi").select("name").distinct().withColumn("is_fresh", F.lit(True))
    return hashes.join(newest, "name", "left").join(matching, "name", "left").na.fill(False, ["is_fresh"])


def source_hash(spark: SparkSession, d: Dataset) -> DataFrame:
    """Hash of the paths and modification times of a source's files, summed over files in no order."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(d.path).select("path", "modificationTime", "length")
    sums = [F.sum(F.xxhash64(F.lit(k), "path", "modificationTime", "length").cast("decimal(38,0)")).cast("string") for k in range(2)]
    return listed.agg(short_hash(F.count("*").cast("string"), *sums, F.lit(d.version)).alias("hash")).select(F.lit(d.name).alias("name"), "hash")


def select_datasets(registry: DataFrame, **wanted) -> DataFrame:
    """The datasets whose columns have the given values; a null column matches only None."""
    for column, value in wanted.items():
        registry = registry.where(F.col(column).eqNullSafe(F.lit(value)))
    return registry


def summary(registry: DataFrame) -> DataFrame:
    """Datasets, restricted ones and direct dependencies per kind and level."""
    return registry.groupBy("kind", "level").agg(
        F.count("*").alias("n"), F.count_if("restricted").alias("n_restricted"), F.sum(F.coalesce(F.size("depends"), F.lit(0))).cast("long").alias("n_depends")
    )


def lineage(edges: DataFrame) -> DataFrame:
    """Transitive closure of (name, parent) with the longest path between the two.

    One join per level of depth, each from a checkpoint of the level before, so
    neither the plan nor a recursion limit grows with the catalogue.
    """
    steps = edges.select("name", "parent").distinct()
    walk = steps.select("name", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    found, depth = walk, 1
    while True:
        depth += 1
        if not walk.where("name = ancestor").isEmpty():
            raise ValueError("dependencies form a cycle")
        hop = steps.withColumnsRenamed({"name": "ancestor", "parent": "_next"})
        walk = durable(walk.join(unbroadcast(hop), "ancestor").select("name", F.col("_next").alias("ancestor"), F.lit(depth).alias("depth")).distinct())
        if walk.isEmpty():
            break
        found = found.unionAll(walk)
    return found.groupBy("name", "ancestor").agg(F.max("depth").alias("depth"))


def impact(edges: DataFrame) -> DataFrame:
    """How many datasets are downstream of each."""
    return lineage(edges).groupBy("ancestor").agg(F.count("*").alias("n_downstream"))


def build_levels(names: DataFrame, edges: DataFrame) -> DataFrame:
    """0 for sources, else one more than the deepest dependency."""
    deepest = lineage(edges).groupBy("name").agg(F.max("depth").alias("level"))
    return names.join(unbroadcast(deepest), "name", "left").na.fill(0, ["level"])


def derive_hashes(known: DataFrame, table: DataFrame, edges: DataFrame, levels: DataFrame) -> DataFrame:
    """Hash of each derived dataset from its dependencies' hashes in order, one level at a time."""
    levelled = durable(edges.join(unbroadcast(levels), "name").join(unbroadcast(table), "name").select("name", "parent", "pos", "version", "level"))
    depth = levelled.agg(F.max("level")).first()[0] or 0
    out = known
    for level in range(1, depth + 1):
        here = levelled.where(F.col("level") == level).drop("level")
        parts = here.join(unbroadcast(out.withColumnsRenamed({"name": "parent", "hash": "_h"})), "parent").groupBy("name", "version").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_h"))), lambda s: s["_h"]), "-").alias("_joined")
        )
        made = parts.select("name", short_hash(F.col("_joined"), F.nullif(F.col("version"), F.lit(""))).alias("hash"))
        out = out.unionAll(durable(made))
    return out
