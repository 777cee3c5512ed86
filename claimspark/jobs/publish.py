"""Publishing copies of finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from claimspark.functions.compat import typed_null


def publish_copy(src: DataFrame, columns: Sequence[str], unfilled: Mapping[str, str] | None = None) -> DataFrame:
    """Snapshot of a table with a fixed column list; columns that the source never fills are NULL of their type."""
    unfilled = unfilled or {}
    return src.select(*(typed_null(unfilled[c]).alias(c) if c in unfilled else src[c] for c in columns))
