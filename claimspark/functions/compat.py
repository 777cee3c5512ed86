"""Column helpers that keep the legacy warehouse's NULL, padding and text rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_to_null(df: DataFrame) -> DataFrame:
    """``''`` means NULL: applied once to every text column at ingestion, without trimming."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nvl(col: Column, default) -> Column:
    return F.coalesce(col, default if isinstance(default, Column) else F.lit(default))


def decode(col: Column, *pairs) -> Column:
    """``decode(c, s1, r1, ..., default)`` where a NULL search value equals a NULL column."""
    args = [p if isinstance(p, Column) else F.lit(p) for p in pairs]
    default = args.pop() if len(args) % 2 else F.lit(None)
    expr = None
    for search, result in zip(args[::2], args[1::2]):
        hit = col.eqNullSafe(search)
        expr = F.when(hit, result) if expr is None else expr.when(hit, result)
    return default if expr is None else expr.otherwise(default)


def oracle_concat(*cols: Column) -> Column:
    """Concatenation in which NULL counts as the empty text."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def lpad_code(col: Column, width: int) -> Column:
    """Zero-pad to ``width``; longer values are cut to the first ``width`` characters."""
    return F.lpad(col.cast("string"), width, "0")


def pad_if(col: Column, width: int) -> Column:
    """Zero-padded when it fits the width, else NULL."""
    return F.when(F.length(col) <= width, F.lpad(col, width, "0"))


def keep_if_len(col: Column, width: int) -> Column:
    return F.when(F.length(col) <= width, col)


def recode(col: Column, mapping: Mapping[str, str], default=None) -> Column:
    """Code-to-code recode; anything not listed (NULL included) gets ``default``."""
    default_col = default if isinstance(default, Column) else F.lit(default)
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col), default_col)


def after_first(col: Column, sep: str) -> Column:
    """Text after the first ``sep``; the whole text when ``sep`` is absent."""
    return F.when(F.instr(col, sep) > 0, F.substring(col, F.instr(col, sep) + len(sep), F.length(col))).otherwise(col)


def to_id(col: Column) -> Column:
    """Integer part of a numeric text id, as text; NULL when it is not a number."""
    number = col.try_cast("decimal(38,6)")
    return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("string")


def try_int(col: Column) -> Column:
    return col.try_cast("int")


def is_flag(cond: Column, yes=1, no=0) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
