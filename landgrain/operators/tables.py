"""Table reshaping, combining and summarising (P, A, N)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


# -- names and rows ----------------------------------------------------------


def rename_to_model(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Source names to model names; a column already using a model name moves to `_name`."""
    taken = {new: f"_{new}" for old, new in aliases.items() if old != new and new in df.columns and old in df.columns}
    return df.withColumnsRenamed(taken).withColumnsRenamed(aliases)


def tidy_columns(df: DataFrame, keep: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Keep columns, some under new names."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in keep])


def sum_columns(columns: list[str]) -> Column:
    """Sum of columns, nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def multiply_families(df: DataFrame, area: str, rates: dict[str, str], drop: bool = True) -> DataFrame:
    """For every item with an `{area}item` column, rate x area under the mapped prefix.

    rates maps a rate prefix to a result prefix, e.g. {"tph_": "t_"}.
    """
    items = [c[len(area):] for c in df.columns if c.startswith(area)]
    made = {
        new + i: F.col(old + i) * F.col(area + i) for old, new in rates.items() for i in items if old + i in df.columns
    }
    out = df.withColumns(made)
    return out.drop(*[old + i for old in rates for i in items]) if drop else out


def any_positive(df: DataFrame, prefix: str) -> Column:
    """Does any column of a family hold a positive amount."""
    return sum_columns([c for c in df.columns if c.startswith(prefix)]) > 0


def trim_outliers(df: DataFrame, column: str, spread: float = 3.0) -> DataFrame:
    """Drop zeros and values of at least `spread` standard deviations."""
    limit = df.agg((F.lit(spread) * F.stddev(column)).alias("_limit"))  # one row
    return df.crossJoin(F.broadcast(limit)).where((F.col(column) != 0) & (F.abs(F.col(column)) < F.col("_limit"))).drop("_limit")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in a total order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


# -- wide and long -----------------------------------------------------------


def pivot_long(df: DataFrame, columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """A10."""
    return df.unpivot([c for c in df.columns if c not in columns], columns, name, value)


def pivot_wide(df: DataFrame, name: str = "name", value: str = "value", values: list | None = None) -> DataFrame:
    """One column per name; a known list of names saves a pass."""
    others = [c for c in df.columns if c not in (name, value)]
    return df.groupBy(*others).pivot(name, values).agg(F.first(value))


def combine_wide(
    frames: list[DataFrame], sources: list[str], keys: list[str] = ("id_parcel",), rename: list[str] = ("proportion",)
) -> DataFrame:
    """Full outer join of tables on keys; each table's metric carries its source name."""
    named = [df.withColumnsRenamed({c: f"{c}_{s}" for c in rename}) for df, s in zip(frames, sources)]
    return reduce(lambda a, b: a.join(b, list(keys), "outer"), named)


def combine_long(frames: list[DataFrame], sources: list[str]) -> DataFrame:
    """Tables stacked with a source column, missing columns null."""
    tagged = [df.withColumn("source", F.lit(s)) for df, s in zip(frames, sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stack_structs(df: DataFrame, groups: list[dict[str, Column]], keys: list[str]) -> DataFrame:
    """Several column groups as rows of one shape."""
    rows = [F.struct(*[c.alias(n) for n, c in g.items()]) for g in groups]
    return df.select(*keys, F.inline(F.array(*rows)))


# -- summaries ---------------------------------------------------------------


def weighted_means(df: DataFrame, keys: list[str], weight: str, columns: list[str], digits: int = 5) -> DataFrame:
    """A3: rounded weighted means over rows of positive weight."""
    w = F.col(weight)
    return df.where(w > 0).groupBy(*keys).agg(*[F.round(F.sum(w * F.col(c)) / F.sum(w), digits).alias(c) for c in columns])


def weighted_mean_or_zero(value, weight) -> Column:
    """A4: aggregate; rows with a null value still weigh in, an empty mean is 0."""
    v, w = F.col(value), F.col(weight)
    return F.coalesce(F.try_divide(F.sum(w * v), F.sum(w)), F.lit(0.0))


def clamped_sum(value: str, low: float | None = 0.0, high: float | None = 1.0) -> Column:
    """A5."""
    total = F.sum(value)
    if low is not None:
        total = F.greatest(total, F.lit(low))
    return F.least(total, F.lit(high)) if high is not None else total


def joined_set(c: str, separator: str = ",") -> Column:
    """Sorted distinct values as one string."""
    return F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), separator)


def with_subtotals(df: DataFrame, levels: dict[str, str]) -> DataFrame:
    """The rows again with each given column replaced by a total label, in order."""
    out = df
    for column, label in levels.items():
        out = out.unionByName(df.withColumn(column, F.lit(label)))
    return out


def grid_totals(df: DataFrame, x: str, y: str, size: int, columns: list[str]) -> DataFrame:
    """Sums per square cell, missing sums as 0."""
    cx, cy = (F.floor(F.col(x) / size) * size).cast("long"), (F.floor(F.col(y) / size) * size).cast("long")
    return df.groupBy(cx.alias("cell_x"), cy.alias("cell_y")).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def share_of_total(value: str, keys: list[str], name: str = "share") -> dict[str, Column]:
    """Group total on every row, and the row's share; for groups of bounded size."""
    total = F.sum(value).over(W.partitionBy(*keys))
    return {f"{value}_total": total, name: F.try_divide(F.col(value), total)}


def with_group_total(df: DataFrame, keys: list[str], value: str, name: str = "share") -> DataFrame:
    """A21 for groups of any size: totals are aggregated map-side and joined back, so no group sits in one task."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(f"{value}_total"))
    return df.join(totals, keys).withColumn(name, F.try_divide(F.col(value), F.col(f"{value}_total")))


def census(column: str) -> list[Column]:
    """Counts of 0, 1, other and null with summary statistics."""
    c = F.col(column)
    return [
        F.count_if(c == 0).alias("n_zero"),
        F.count_if(c == 1).alias("n_one"),
        F.count_if((c != 0) & (c != 1)).alias("n_other"),
        F.count_if(c.isNull()).alias("n_null"),
        (F.count_if(c.isNull()) / F.count("*")).alias("null_share"),
        F.avg(c).alias("mean"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ]


def period_rollup(
    df: DataFrame, keys: list[str], period: str, label: str, averages: list[str], totals: list[str], years: str, weights: dict[str, float] | None = None
) -> DataFrame:
    """One more row per group over all periods: year-weighted averages and totals.

    weights scales the years of named periods (20/50 of the last one, say).
    """
    scale = F.lit(1.0)
    for name, factor in (weights or {}).items():
        scale = F.when(F.col(period) == name, F.lit(float(factor))).otherwise(scale)
    y = F.col(years) * scale
    rolled = df.groupBy(*keys).agg(
        *[(F.sum(F.col(c) * y) / F.sum(y)).alias(c) for c in averages], *[F.sum(F.col(c) * scale).alias(c) for c in totals]
    )
    return df.select(*keys, period, *averages, *totals).unionByName(rolled.withColumn(period, F.lit(label)))


def scenario_grid(df: DataFrame, keys: list[str], scenarios: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Every scenario evaluated on every row in one grouped pass.

    scenarios is a parameter list of a few rows written in code.
    """
    rows = df.crossJoin(F.broadcast(scenarios))
    return rows.groupBy(*scenarios.columns, *keys).agg(*[F.expr(e).alias(n) for n, e in metrics.items()])
