"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL, if it can be written in SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns so that both engines agree; turns -0.0 into 0.0."""
    doubles = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[
        (F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) if c in doubles else F.col(c)
        for c in df.columns])
