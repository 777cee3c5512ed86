"""Projection helpers: fixed target schemas, stacking, mapped renames, rule cascades."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the target columns, by name, in order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def add_typed_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Like ``select_schema``, with absent columns filled by typed NULLs."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def stack(dfs: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """UNION ALL of aligned sources."""
    parts = [add_typed_nulls(d, schema) for d in dfs] if schema else list(dfs)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def id_bridge(*sources: DataFrame) -> DataFrame:
    """UNION (distinct) of identifier sources, by position."""
    return reduce(lambda a, b: a.union(b), sources).distinct()


def rule_cascade(rules: Sequence[tuple[Column, str]], default: str | None = None) -> tuple[Column, Column]:
    """First matching rule wins: (its value, its 1-based number)."""
    value = number = None
    for i, (cond, result) in enumerate(rules, 1):
        value = F.when(cond, F.lit(result)) if value is None else value.when(cond, F.lit(result))
        number = F.when(cond, F.lit(str(i))) if number is None else number.when(cond, F.lit(str(i)))
    return value.otherwise(F.lit(default)), number.otherwise(F.lit(default))


def describe(col: Column, labels: dict[str, str], default: str | None) -> Column:
    """Description text of a code."""
    expr = None
    for code, text in labels.items():
        expr = F.when(col == code, text) if expr is None else expr.when(col == code, text)
    return expr.otherwise(F.lit(default))


def with_rolling_period(periods: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """The period table plus one computed ``Rolling 12`` row."""
    row = periods.sparkSession.range(1).select(
        F.lit("Rolling 12").alias("measurement_period_desc"),
        F.year(hi).cast("string").alias("effyear"),
        lo.cast("date").alias("start_dt"),
        hi.cast("date").alias("end_dt"),
    )
    return periods.select("measurement_period_desc", "effyear", "start_dt", "end_dt").unionByName(row)
