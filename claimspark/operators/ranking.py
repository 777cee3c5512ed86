"""Ranking and deduplication that stay safe when one key holds a large share of the rows.

``keep_first`` and ``top_n`` filter on the rank, so Spark prunes each map task to the first
``n`` rows of a key before the shuffle: a hot key sends at most ``n`` rows per task.

Full numbering cannot be pruned. ``rank_rows`` is a window, for keys that bound their rows.
``number_rows`` is for all other keys: it range-partitions on the whole sort key, numbers each
range on its own and adds the row counts of the ranges before it; ``running_starts`` does so for sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.session import stored


def top_n(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int, rank_col: str = "rn") -> DataFrame:
    """The first ``n`` rows per key, with their rank."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= n)


def keep_first(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_n(df, keys, order, 1, "_rn").drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], col: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Most recent row per key. NULL counts as the latest, as in the legacy descending order."""
    return keep_first(df, keys, [F.col(col).desc_nulls_first(), *ties])


def nodupkey(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key. With no order, only the keys are meaningful and only they are kept."""
    return keep_first(df, keys, order) if order else df.select(*keys).distinct()


def number_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], out: str, partitions: int | None = None
) -> DataFrame:
    """``row_number`` per group with no group held by one task, and one shuffle of the rows.

    Rows are dealt into ranges of the whole sort key and sorted there, so a row's place in its range is known as it is
    written; a group's places start where earlier ranges left off. Only a small table of ranges and groups is added up
    and joined back. Rows equal on the whole order are interchangeable; ``_tie`` spreads such copies.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    full_order = [*[F.col(g).asc() for g in groups], *order, F.col("_tie").asc()]
    dealt = tagged.repartitionByRange(n, *full_order).sortWithinPartitions(*full_order).drop("_tie")
    # written, so that both uses below see the same ranges; the id counts the rows of each range in its low 33 bits
    ranged = stored(dealt.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumns({"_part": F.shiftright("_id", 33), "_in": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")

    # one row per (range, group): a group only spans neighbouring ranges
    counts = ranged.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_in").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"),
    )
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    numbered = ranged.join(stored(offsets, "offsets"), on, "left")
    return numbered.withColumn(out, (F.col("_in") + F.col("_off")).cast("long")).select(*df.columns, out)


def running_starts(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], size: str, out: str, partitions: int | None = None
) -> DataFrame:
    """The sum of ``size`` over all earlier rows of the group, with no group held by one task.

    Like ``number_rows``: summed within ranges of the whole sort key, to which each range adds the sums of those before it.
    Rows equal on the whole order are interchangeable.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    full_order = [*[F.col(g).asc() for g in groups], *order, F.col("_tie").asc()]
    dealt = tagged.repartitionByRange(n, *full_order).withColumn("_part", F.spark_partition_id())
    ranged = stored(dealt, "size-ranges")
    totals = ranged.groupBy(*groups, "_part").agg(F.sum(size).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    inside = Window.partitionBy("_part", *groups).orderBy(*order, F.col("_tie").asc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(stored(offsets, "offsets"), on, "left")
    return summed.withColumn(out, (F.col("_in") + F.col("_off")).cast("long")).select(*df.columns, out)


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn") -> DataFrame:
    """Rank of every row within its key, for keys that bound their rows, such as a claim. Others take ``number_rows``."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def keep_best(df: DataFrame, passes: Sequence[tuple[Sequence, Sequence[Column]]]) -> DataFrame:
    """Successive keep-first passes, each with its own key and order."""
    for keys, order in passes:
        df = keep_first(df, keys, order)
    return df
