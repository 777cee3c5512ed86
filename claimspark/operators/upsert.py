"""Keyed upsert with a policy per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.operators.ranking import keep_first

POLICIES = ("replace", "prefer_nonempty", "append_distinct")


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    policy: Mapping[str, str],
    insert_unmatched: bool = True,
    last_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Merge ``new`` into ``old``.

    ``replace``: a present new row always wins, even with an empty value. ``prefer_nonempty``: a
    blank new value keeps the old one, also an empty old one; only an inserted row takes it. ``append_distinct``: new array items not already there are
    added at the end. ``last_by`` picks the surviving row when ``new`` repeats a key.
    """
    unknown = set(policy.values()) - set(POLICIES)
    if unknown:
        raise ValueError(f"unknown policies: {sorted(unknown)}")
    if last_by:
        new = keep_first(new, keys, last_by)
    incoming = new.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in policy], F.lit(True).alias("_hit")
    )
    known = old.withColumn("_known", F.lit(True))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = known.join(incoming, cond, "full" if insert_unmatched else "left")

    def merged(c: str) -> Column:
        if c in keys:
            return F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_k_{c}")).alias(c)
        rule = policy.get(c)
        if rule is None:
            return F.col(c)
        newer = F.col(f"_n_{c}")
        if rule == "replace":
            return F.when(F.col("_hit"), newer).otherwise(F.col(c)).alias(c)
        if rule == "prefer_nonempty":
            blank = newer.isNull() | (F.regexp_replace(newer.cast("string"), r"(?U)\s+", "") == "")
            return F.when(blank & F.col("_known"), F.col(c)).otherwise(newer).alias(c)
        empty = F.array().cast(old.schema[c].dataType)
        base, extra = F.coalesce(F.col(c), empty), F.array_distinct(F.coalesce(newer, empty))
        return F.concat(base, F.filter(extra, lambda x: ~F.coalesce(F.array_contains(base, x), F.lit(False)))).alias(c)

    return joined.select(*[merged(c) for c in old.columns])
