"""Declared data-quality rules checked over whole tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What must hold for one column."""

    type: str | None = None
    nullable: bool = True
    unique: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None
    isin: tuple = ()
    matches: str | None = None
    alias: str | None = None

    def checks(self, name: str) -> dict[str, Column]:
        """Named conditions that hold for a bad row."""
        c = F.col(f"`{name}`")
        bad: dict[str, Column] = {}
        if not self.nullable:
            bad["not_null"] = c.isNull()
        if self.ge is not None:
            bad["ge"] = c < self.ge
        if self.gt is not None:
            bad["gt"] = c <= self.gt
        if self.le is not None:
            bad["le"] = c > self.le
        if self.lt is not None:
            bad["lt"] = c >= self.lt
        if self.isin:
            bad["isin"] = ~c.isin(*self.isin)
        if self.matches:
            bad["matches"] = ~c.rlike(self.matches)
        return bad


@dataclass(frozen=True)
class Model:
    """Rules by column, plus named row conditions that must hold."""

    columns: dict[str, Rule] = field(default_factory=dict)
    invariants: dict[str, str] = field(default_factory=dict)

    @property
    def aliases(self) -> dict[str, str]:
        return {r.alias: n for n, r in self.columns.items() if r.alias}

    def coerce(self, df: DataFrame) -> DataFrame:
        """Cast the columns that declare a type."""
        casts = {n: F.col(n).cast(r.type) for n, r in self.columns.items() if r.type and n in df.columns}
        return df.withColumns(casts) if casts else df


def validate(df: DataFrame, model: Model) -> DataFrame:
    """A report (column, rule, failures) from one aggregate over all rows; unique rules add a keyed pass each."""
    checks, labels = [], []
    for name, rule in model.columns.items():
        if name not in df.columns:
            labels.append((name, "present"))
            checks.append(F.lit(1).cast("long"))
            continue
        for label, bad in rule.checks(name).items():
            labels.append((name, label))
            checks.append(F.count_if(F.coalesce(bad, F.lit(False))))
        if rule.type and dict(df.dtypes)[name] != rule.type:
            cast = F.col(f"`{name}`").try_cast(rule.type)
            labels.append((name, "type"))
            checks.append(F.count_if(cast.isNull() & F.col(f"`{name}`").isNotNull()))
    for label, condition in model.invariants.items():
        labels.append(("*", label))
        checks.append(F.count_if(~F.coalesce(F.expr(condition), F.lit(True))))
    frames = []
    if checks:
        row = F.array(
            *[
                F.struct(F.lit(n).alias("column"), F.lit(r).alias("rule"), c.cast("long").alias("failures"))
                for (n, r), c in zip(labels, checks)
            ]
        )
        frames.append(df.agg(row.alias("r")).select(F.inline("r")))
    for name, rule in model.columns.items():
        if rule.unique and name in df.columns:
            repeated = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).where("n > 1")
            frames.append(
                repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failures")).select(
                    F.lit(name).alias("column"), F.lit("unique").alias("rule"), "failures"
                )
            )
    if not frames:
        return df.sparkSession.createDataFrame([], "column string, rule string, failures long")
    return reduce(DataFrame.unionByName, frames)


class RuleError(ValueError):
    pass


def require(df: DataFrame, model: Model) -> DataFrame:
    """Coerce and validate; raises with the list of broken rules."""
    coerced = model.coerce(df)
    report = validate(df, model).where("failures > 0").collect()
    if report:
        raise RuleError("; ".join(f"{r['column']} {r['rule']}: {r['failures']}" for r in report))
    return coerced


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the left table with no row in the right one."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def merge_validated(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", expect: str = "m:m") -> DataFrame:
    """A join that first checks key uniqueness on the sides declared `1`."""
    for side, df in zip(expect.split(":"), (left, right)):
        if side == "1":
            twice = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
            if not twice.isEmpty():
                raise RuleError(f"keys {keys} are not unique")
    return left.join(right, keys, how)
