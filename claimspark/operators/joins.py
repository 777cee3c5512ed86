"""Join helpers: role dims, NULL-tolerant keys, period ranges. Which side is broadcast is left to Spark's size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = 64


def spread_nulls(key: Column, salt_on: Column) -> Column:
    """A text join key whose NULLs are spread over ``SALT`` values that match nothing.

    In a left join NULL keys find no partner, but would all be sent to one task.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(salt_on), F.lit(SALT)).cast("string")))


def join_role(
    df: DataFrame, dim: DataFrame, key: Column, dim_key: str, prefix: str, cols: Sequence[str], salt_on: str | None = None
) -> DataFrame:
    """Left join a dimension in one role: its columns arrive as ``<prefix>_<name>``.

    A dimension used in several roles is prefixed each time, so no reference is ambiguous.
    ``salt_on`` names a well-spread column of ``df``; with it, NULL keys are spread.
    """
    role = dim.select(F.col(dim_key).alias(f"_{prefix}_key"), *[F.col(c).alias(f"{prefix}_{c}") for c in cols])
    left = spread_nulls(key, F.col(salt_on)) if salt_on else key
    return df.join(role, left == F.col(f"_{prefix}_key"), "left").drop(f"_{prefix}_key")


def within_key(df: DataFrame, other: DataFrame, keys: Sequence[str], col: str, other_col: str) -> DataFrame:
    """Left join on ``keys`` and ``col = other_col``, for ``other`` with few rows a key, such as a member's months.

    ``col`` is compared among the rows of a key. As a join key, it would have rows that lie by ``keys`` dealt anew.
    """
    renamed = other.select(*[F.col(c).alias(f"_w_{c}") if c in keys else F.col(c) for c in other.columns])
    cond = (F.col(col) >= F.col(other_col)) & (F.col(col) <= F.col(other_col))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_w_{k}"))
    return df.join(renamed, cond, "left").drop(other_col, *[f"_w_{k}" for k in keys])


def null_tolerant_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "left", never_on_null: Sequence[str] = ()
) -> DataFrame:
    """Equi-join in which NULL matches NULL, except on the keys in ``never_on_null``.

    ``keys`` maps left to right column names; the right key columns are dropped.
    ``<=>`` is a hashable join key for Spark, so no row pairs are compared.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys.values() else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for lcol, rcol in keys.items():
        r = F.col(f"_r_{rcol}")
        cond = cond & ((F.col(lcol) == r) if lcol in never_on_null else F.col(lcol).eqNullSafe(r))
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in keys.values()])


def semi_filter(df: DataFrame, ref: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Keep rows whose key is in the reference list; duplicates in the list do not matter."""
    marks = ref.select(*[F.col(r).alias(f"_ref_{i}") for i, r in enumerate(on.values())])
    cond = F.lit(True)
    for i, lcol in enumerate(on):
        cond = cond & (F.col(lcol) == F.col(f"_ref_{i}"))
    return df.join(marks, cond, "left_semi")


def filter_in_table(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """``col IN (list built from a query)`` as a join, not a literal list."""
    return semi_filter(df, ref, {col: ref_col})


def flag_exists(df: DataFrame, other: DataFrame, on: Mapping[str, str], name: str, yes=1, no=0) -> DataFrame:
    """Membership indicator; the other side is made unique first, so rows never fan out."""
    marks = other.select(*[F.col(r).alias(f"_m_{i}") for i, r in enumerate(on.values())]).distinct()
    cond = F.lit(True)
    for i, lcol in enumerate(on):
        cond = cond & (F.col(lcol) == F.col(f"_m_{i}"))
    joined = df.join(marks, cond, "left")
    flag = F.when(F.col("_m_0").isNotNull(), F.lit(yes)).otherwise(F.lit(no))
    return joined.withColumn(name, flag).drop(*[f"_m_{i}" for i in range(len(on))])


def period_months(periods: DataFrame, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """One row per (period, month start) that the period touches."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    return periods.where(F.col(start) <= F.col(end)).withColumn("_month", F.explode(months))


def range_join(df: DataFrame, periods: DataFrame, col: str, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """``df JOIN periods ON df.col BETWEEN start AND end`` as a hash join on the month.

    The fact side is spread over ``SALT`` sub-keys of each month and the periods are repeated for each, so no month is one
    task when both sides are shuffled; periods small enough are broadcast by Spark, and then nothing moves.
    """
    months = period_months(periods, start, end).withColumn("_msalt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    fact = df.withColumns({"_fact_month": F.trunc(col, "MM"), "_salt": F.pmod(F.xxhash64(*df.columns), F.lit(SALT)).cast("int")})
    cond = (F.col("_fact_month") == F.col("_month")) & (F.col("_salt") == F.col("_msalt")) & F.col(col).between(F.col(start), F.col(end))
    return fact.join(months, cond).drop("_fact_month", "_month", "_salt", "_msalt")
