"""The list of runnable queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under a name, with its check SQL."""

    def add(fn):
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add
