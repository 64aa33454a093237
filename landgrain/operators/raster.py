"""Rasters as pixel tables (scene, scene_rank, band, col, row, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrain.functions import geometry as G
from landgrain.operators.quantiles import with_quantiles
from landgrain.operators.nearest import knn_nearest
from landgrain.operators.scanlines import cells, cells_within
from landgrain.operators.spatial_join import Grid, sjoin

PIXEL = ["col", "row"]


# -- cell arithmetic ----------------------------------------------------------


def normalised_difference(a, b) -> Column:
    """(a - b) / (a + b), null where the sum is 0."""
    a, b = G._col(a), G._col(b)
    return F.try_divide(a - b, a + b)


def apply_offset(value, offset, floor_zero: bool = True) -> Column:
    """R2: add a radiometric offset, not below 0; an offset of 0 changes nothing."""
    v, o = G._col(value), offset if isinstance(offset, Column) else F.lit(float(offset))
    moved = F.greatest(v + o, F.lit(0.0)) if floor_zero else v + o
    return F.when(v.isNull(), F.lit(None)).when(o == 0, v).otherwise(moved)


def mask_value(value, nodata: float) -> Column:
    """A no-data value becomes null."""
    return F.nullif(G._col(value), F.lit(float(nodata)))


def trim(value, limit: float) -> Column:
    """Values at or above a limit become null."""
    v = G._col(value)
    return F.when(v < limit, v)


def resample_nearest(fine: DataFrame, coarse: DataFrame, factor: int, value: str, keys: list[str] = ()) -> DataFrame:
    """Value of the coarse cell each fine cell lies in."""
    listed = fine.withColumns({"_c": F.floor(F.col("col") / factor), "_r": F.floor(F.col("row") / factor)})
    source = coarse.select(*keys, F.col("col").alias("_c"), F.col("row").alias("_r"), value)
    return listed.join(source, [*keys, "_c", "_r"], "left").drop("_c", "_r")


def band_columns(pixels: DataFrame, bands: list[str], keys: list[str] = ("scene", "scene_rank")) -> DataFrame:
    """One row per scene and pixel with a column per band."""
    picks = [F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands]
    return pixels.groupBy(*keys, *PIXEL).agg(*picks)


def ndvi_cloud(stack: DataFrame, red: str, nir: str, cloud: str, offset: float = 0.0) -> DataFrame:
    """Vegetation index and cloud probability; the cloud value is null where red is null."""
    r, n = apply_offset(mask_value(red, 0), offset), apply_offset(mask_value(nir, 0), offset)
    return stack.withColumns(
        {
            "ndvi": normalised_difference(trim(n, 10_000) / 10_000, trim(r, 10_000) / 10_000),
            "cloud": F.when(mask_value(red, 0).isNotNull(), F.col(cloud) / 100),
        }
    )


def ndvi_ndsi(stack: DataFrame, red: str, nir: str, green: str, swir: str, offset: float = 0.0) -> DataFrame:
    """Vegetation index, and the index of short-wave infrared against green that snow and cloud lower.

    The radiometric offset is added first; 0 is no data after it.
    """
    r, n, g, s = (mask_value(apply_offset(band, offset), 0) for band in (red, nir, green, swir))
    return stack.withColumns({"ndvi": normalised_difference(n, r), "ndsi": normalised_difference(s, g)})


# -- composites ---------------------------------------------------------------


def clearest_pixels(scenes: DataFrame, values: list[str], limit: float = 0.2) -> DataFrame:
    """Per pixel the scene of least cloud, earlier scene on ties; cloudier than `limit` is masked.

    A pixel without any cloud value takes the last scene.
    """
    known = F.col("cloud").isNotNull()
    order = F.struct(
        (~known).alias("missing"),
        F.col("cloud").alias("c"),
        F.when(known, F.col("scene_rank")).otherwise(-F.col("scene_rank")).alias("r"),
    )
    pick = F.min_by(F.struct(*values, "cloud", "scene"), order)
    best = scenes.groupBy(*PIXEL).agg(pick.alias("p")).select(*PIXEL, "p.*")
    clear = F.coalesce(F.col("cloud") <= limit, F.lit(True))
    return best.withColumns({v: F.when(clear, F.col(v)) for v in values})


def snow_free_pixels(scenes: DataFrame, values: list[str], snow: float = 0.32) -> DataFrame:
    """The first scene in order that needs no replacement, else the last scene.

    A scene is replaced by the next while its snow index is below `snow` or it has no
    vegetation index.
    """
    good = (F.col("ndvi").isNotNull()) & ~F.coalesce(F.col("ndsi") < snow, F.lit(False))
    order = F.struct((~good).alias("bad"), F.when(good, F.col("scene_rank")).otherwise(-F.col("scene_rank")).alias("r"))
    return scenes.groupBy(*PIXEL).agg(F.min_by(F.struct(*values, "scene"), order).alias("p")).select(*PIXEL, "p.*")


# -- summaries -----------------------------------------------------------------


def cloud_cover(mask: str = "mask") -> list[Column]:
    """Share of cells that are cloud for certain and share that is uncertain."""
    m = F.col(mask)
    return [F.avg((m == 1).cast("double")).alias("share_cloud"), F.avg(((m > 0) & (m < 1)).cast("double")).alias("share_uncertain")]


def summary(pixels: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Extremes, moments, exact median and share of nulls per group."""
    v = F.col(value)
    rest = pixels.groupBy(*keys).agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.var_pop(v).alias("variance"),
        F.stddev_pop(v).alias("std"),
        (F.count_if(v.isNull()) / F.count("*")).alias("null_share"),
    )
    return with_quantiles(rest, pixels, keys, value, {"median": 0.5})


def fill_nearest(pixels: DataFrame, value: str = "value") -> DataFrame:
    """Missing cells take the value of the nearest valid cell, the smaller (row, col) on ties."""
    known = pixels.where(F.col(value).isNotNull())
    holes = pixels.where(F.col(value).isNull()).select("col", "row", F.struct("row", "col").alias("hole"))
    source = known.select(F.struct("row", "col").alias("src"), G.point("col", "row").alias("geometry"))
    near = knn_nearest(holes.withColumn("geometry", G.point("col", "row")), source, "hole", "src", 1)
    filled = (
        near.select(F.col("hole.col").alias("col"), F.col("hole.row").alias("row"), F.col("src.col").alias("_sc"), F.col("src.row").alias("_sr"))
        .join(known.select(F.col("col").alias("_sc"), F.col("row").alias("_sr"), value), ["_sc", "_sr"])
        .select("col", "row", value)
    )
    return known.select("col", "row", value).unionAll(filled)


# -- rasters and geometry -------------------------------------------------------


def cell_of(x, y, x0: float, y0: float, res: float) -> tuple[Column, Column]:
    x, y = G._dbl(x), G._dbl(y)
    return F.floor((x - x0) / res).cast("long"), F.floor((y - y0) / res).cast("long")


def centroid_lookup(df: DataFrame, pixels: DataFrame, x0: float, y0: float, res: float, value: str = "value") -> DataFrame:
    """Value of the cell each geometry's centroid falls in."""
    c = G.centroid("geometry")
    col, row = cell_of(c["x"], c["y"], x0, y0, res)
    return df.withColumns({"col": col, "row": row}).join(pixels.select("col", "row", value), ["col", "row"], "left").drop("col", "row")


def _boxes(pixels: DataFrame, x0: float, y0: float, res: float) -> DataFrame:
    x, y = F.col("col") * res + x0, F.col("row") * res + y0
    return pixels.withColumn("geometry", G.rectangle(x, y, x + res, y + res))


def zonal(
    zones: DataFrame,
    pixels: DataFrame,
    key: str,
    aggs: list[Column],
    x0: float,
    y0: float,
    res: float,
    all_touched: bool = False,
    grid: Grid = Grid(),
) -> DataFrame:
    """Aggregates of the cells of each zone: by cell centre, or every cell the zone touches."""
    if all_touched:
        pairs = sjoin(zones.select(key, "geometry"), _boxes(pixels, x0, y0, res), 0.0, grid)
    else:
        pairs = cells_within(zones, pixels, key, res, x0, y0)
    return pairs.groupBy(key).agg(*aggs)


def bare_share(value: str, threshold: float = 0.25, null_as_zero: bool = False) -> Column:
    """R13 aggregate: share of cells with an index below a threshold."""
    v = F.col(value)
    bare = F.when(v < threshold, 1.0).when(v.isNotNull(), 0.0)
    return F.avg(F.coalesce(bare, F.lit(0.0)) if null_as_zero else bare)


def rasterise(df: DataFrame, value: str, res: float) -> DataFrame:
    """Spread a value of each geometry over the cells whose centres it holds, as value per cell area, added up."""
    held = cells(df.select(F.col(value).alias("_v"), G.area("geometry").alias("_area"), "geometry"), res)
    return held.groupBy("col", "row").agg(F.sum(F.col("_v") * (res * res) / F.col("_area")).alias("value"))


# -- scenes ----------------------------------------------------------------------


# The field layout of a scene product name.
SCENE_NAME = r"^(S2[AB])_MSIL2A_(\d{8}T\d{6})_N(\d{4})_R(\d{3})_T(\w{5})_(\d{8}T\d{6})"


def scene_fields(name) -> dict[str, Column]:
    """Mission, time, baseline, orbit, tile and processing time from a product name."""
    n = G._col(name)
    got = [F.regexp_extract(n, SCENE_NAME, i) for i in range(1, 7)]
    stamp = "yyyyMMdd'T'HHmmss"
    return {
        "mission": got[0],
        "captured": F.to_timestamp(F.nullif(got[1], F.lit("")), stamp),
        "baseline": got[2],
        "orbit": got[3],
        "tile": got[4],
        "processed": F.to_timestamp(F.nullif(got[5], F.lit("")), stamp),
    }


def winter_scenes(scenes: DataFrame, year_end: int, tile: str | None = None, captured: str = "captured") -> DataFrame:
    """November and December of the year before, January and February of the year."""
    y, m = F.year(captured), F.month(captured)
    inside = ((y == year_end - 1) & m.isin(11, 12)) | ((y == year_end) & m.isin(1, 2))
    return scenes.where(inside & (F.col("tile") == tile)) if tile else scenes.where(inside)


def usefulness(xml) -> Column:
    """Share of a scene that is land seen clearly, from its metadata document."""
    x = G._col(xml)

    def number(tag):
        return F.xpath_double(x, F.lit(f"//{tag}/text()"))

    return (number("VEGETATION_PERCENTAGE") + number("NOT_VEGETATED_PERCENTAGE")) * (100 - number("NODATA_PIXEL_PERCENTAGE")) / 10_000


def radiometric_offset(xml, band_id: int) -> Column:
    """The offset of one band, 0 when the document has none."""
    got = F.xpath_string(G._col(xml), F.lit(f"//BOA_ADD_OFFSET[@band_id='{band_id}']/text()"))
    return F.coalesce(F.nullif(got, F.lit("")).cast("double"), F.lit(0.0))


def tile_assignment(proportions: DataFrame, key: str = "id_parcel", share: float = 0.9) -> DataFrame:
    """The tiles that hold more than `share` of a parcel, with how many there are."""
    return proportions.where(F.col("proportion") > share).groupBy(key).agg(
        F.count("*").alias("n_tiles"), F.array_join(F.array_sort(F.collect_set("tile")), ",").alias("tiles")
    )


def combine_tiles_and_years(df: DataFrame, key: str, year: str, value: str, years: list[int], keep: str = "max") -> DataFrame:
    """One value per parcel and year over tiles, years side by side; nulls give way to values."""
    pick = F.max if keep == "max" else F.min
    return df.groupBy(key).agg(*[pick(F.when(F.col(year) == y, F.col(value))).alias(f"{value}_{y}") for y in years])


def per_hectare(value) -> Column:
    """Per square kilometre to per hectare."""
    return G._col(value) / 100
