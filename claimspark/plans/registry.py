"""Registry of runnable queries with the independent SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.plans.domain import Domain, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so that two engines compare by value."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            casts[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None, **more: str):
    """Register ``fn(domain) -> DataFrame``; ``{table}`` in ``sql`` names a domain or base table."""

    def wrap(fn: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(fn(Domain(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = oracle(sql, **more)
        return fn

    return wrap
