"""Queries by name, each with the SQL that must give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its equivalent over the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """All doubles rounded, so that engines agree on values.

    Means of decimals often fall on the border between two roundings, where
    the last bits decide; ``nudge`` is added first to move them off it.
    """
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    value = lambda c: F.col(c) + F.lit(nudge) if nudge else F.col(c)
    return df.select(*[F.round(value(c), digits).alias(c) if c in doubles else F.col(c) for c in df.columns])
