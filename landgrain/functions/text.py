"""String, code and date columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgrain.functions.geometry import _col


def clean_name(c) -> Column:
    """lower case, `&` spelled out, commas dropped, known short names completed, trailing s run removed."""
    out = F.replace(F.replace(F.lower(_col(c)), F.lit("&"), F.lit("and")), F.lit(","), F.lit(""))
    out = F.regexp_replace(out, "calaminarian grass(land)*", "calaminarian grassland")
    return F.rtrim(F.replace(out, F.lit("grasslandland"), F.lit("grassland")), F.lit("s"))


def split_labels(c, separator: str = ",", trim: bool = False) -> Column:
    """a multi-label string as an array; pieces keep their blanks unless trim."""
    pieces = F.split(_col(c), re.escape(separator))
    return F.transform(pieces, F.trim) if trim else pieces


def snake_case(c) -> Column:
    """words in lower case joined by underscores."""
    spaced = F.regexp_replace(_col(c), "([a-z0-9])([A-Z])", "$1_$2")
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(spaced)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def parse_template(c, template: str) -> Column:
    """the fields of a path written as a template such as `{type}/rcp{rcp}/{name}.csv`, as a map."""
    names = re.findall(r"{(\w+)}", template)
    pattern = "^" + re.sub(r"\\{\w+\\}", "(.+?)", re.escape(template)) + "$"
    text = _col(c)
    pairs = [x for i, n in enumerate(names, 1) for x in (F.lit(n), F.regexp_extract(text, pattern, i))]
    return F.when(text.rlike(pattern), F.create_map(*pairs))


def leading_score(c) -> Column:
    """the number a description starts with, 0 when there is none or no description."""
    return F.coalesce(F.expr("try_cast(nullif(regexp_extract({0}, '^\\\\s*([0-9]+)', 1), '') AS INT)".format(c)) if isinstance(c, str) else _score(c), F.lit(0))


def _score(c: Column) -> Column:
    digits = F.regexp_extract(c, r"^\s*([0-9]+)", 1)
    return F.when(digits != "", digits).try_cast("int")


# Slope descriptions number four bands, scored out of five.
SLOPE_SCORES = {1: 1, 2: 2, 3: 4, 4: 5}


def slope_score(c) -> Column:
    score = _score(_col(c))
    out = F.when(score == 1, SLOPE_SCORES[1])
    for band in (2, 3, 4):
        out = out.when(score == band, SLOPE_SCORES[band])
    return out


def tag_map(columns: list[str], packed: str) -> Column:
    """tag columns and a packed `"k"=>"v",...` string as one map; nulls are left out."""
    named = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns])
    named = F.filter(named, lambda e: e["value"].isNotNull())
    keys = F.regexp_extract_all(F.coalesce(_col(packed), F.lit("")), F.lit('"([^"]*)"=>"([^"]*)"'), 1)
    values = F.regexp_extract_all(F.coalesce(_col(packed), F.lit("")), F.lit('"([^"]*)"=>"([^"]*)"'), 2)
    listed = F.arrays_zip(keys.alias("key"), values.alias("value"))
    fresh = F.filter(
        F.transform(listed, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))),
        lambda e: ~F.exists(named, lambda n: n["key"] == e["key"]),
    )
    return F.map_from_entries(F.concat(named, fresh))


def label_codes(c, labels: dict, default: str | None = None) -> Column:
    """Code to label; unmatched codes get the default."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, _col(c)), F.lit(default).cast("string"))


def winter_season(ts) -> Column:
    """the season a winter month belongs to, as `2023-24`; other months raise."""
    month, year = F.month(_col(ts)), F.year(_col(ts))
    start = F.when(month <= 2, year - 1).when(month >= 11, year)
    label = F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))
    return F.when(start.isNotNull(), label).otherwise(F.raise_error(F.lit("not a winter month")))


def parse_stamp(c, pattern: str = "yyyyMMddHHmmss") -> Column:
    """F17."""
    return F.to_timestamp(_col(c), pattern)


def short_hash(*parts, separator: str = "-", length: int = 8) -> Column:
    """the first characters of the SHA-256 of the joined parts."""
    return F.substring(F.sha2(F.concat_ws(separator, *[_col(p).cast("string") for p in parts]), 256), 1, length)


def stable_key(*cols) -> Column:
    """a row key that does not depend on partitioning."""
    return F.xxhash64(*[_col(c) for c in cols])


def bin_label(value, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins; the lowest edge itself is outside."""
    v = _col(value)
    out = None
    for lo, hi, name in zip(edges[:-1], edges[1:], labels):
        cond = (v > lo) & (v <= hi)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def parcel_grid_names(id_parcel) -> dict[str, Column]:
    """1 km, 10 km and 100 km tile names read from a parcel key."""
    p = _col(id_parcel)
    km = F.left(p, F.lit(6))
    return {
        "tile_1km": km,
        "tile_10km": F.concat(F.left(km, F.lit(3)), F.left(F.right(km, F.lit(2)), F.lit(1))),
        "tile_100km": F.left(p, F.lit(2)),
    }
