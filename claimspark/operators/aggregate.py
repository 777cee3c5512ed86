"""Aggregations: rolling range sums, overlapping slices, usage rollups, load counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
INPUT_USD_PER_MILLION = 1.25
OUTPUT_USD_PER_MILLION = 10.0
# -----------------------------------------------------------------------------


def rolling_range_agg(
    data: DataFrame,
    drivers: DataFrame,
    period: str,
    keys: Sequence[str],
    sums: Mapping[str, str],
    begin: str = "window_start",
    end: str = "window_end",
) -> DataFrame:
    """For each driver row, the sum over all data whose period lies in its window.

    ``period``, ``begin`` and ``end`` are integers ``yyyyMM``. The data is first summed per
    (period, keys), which bounds it by the number of months; each such row then meets only
    the windows that contain it. A window function would sum over rows, not over the range.
    """
    partial = data.groupBy(period, *keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    as_date = lambda c: F.to_date(F.col(c).cast("string"), "yyyyMM")
    months = F.sequence(as_date(begin), as_date(end), F.expr("interval 1 month"))
    windows = (
        drivers.select(begin, end)
        .where(F.col(begin) <= F.col(end))
        .distinct()
        .withColumn("_p", F.explode(months))
        .withColumn("_p", F.date_format("_p", "yyyyMM").cast("int"))
    )
    return (
        partial.join(windows, F.col(period) == F.col("_p"))
        .groupBy(begin, end, *keys)
        .agg(*[F.sum(out).alias(out) for out in sums])
    )


def slice_agg(df: DataFrame, slices: Mapping[str, Column], label: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregate overlapping filtered slices in one pass: a row counts in every slice it satisfies."""
    hits = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in slices.items()]))
    return df.withColumn(label, F.explode(hits)).groupBy(label, *keys).agg(*aggs)


def slice_agg_union(df: DataFrame, slices: Mapping[str, Column], label: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """The same result as one filtered aggregate per slice, stacked; kept to cross-check ``slice_agg``."""
    parts = [df.where(cond).withColumn(label, F.lit(name)).groupBy(label, *keys).agg(*aggs) for name, cond in slices.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def freq(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Frequency table of a category, missing values left out."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def claim_span(lines: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """First and last service date of each claim."""
    return lines.groupBy(*keys).agg(F.min(day).alias("from_date"), F.max(day).alias("to_date"))


def load_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"))


def usage_cost(tokens_in: Column, tokens_out: Column) -> Column:
    """Cost of one call in USD, rounded to six places, in exact decimals."""
    rate_in = F.lit(str(INPUT_USD_PER_MILLION)).cast("decimal(10,4)")
    rate_out = F.lit(str(OUTPUT_USD_PER_MILLION)).cast("decimal(10,4)")
    million = F.lit("0.000001").cast("decimal(10,6)")
    cost = tokens_in.cast("decimal(18,0)") * rate_in * million + tokens_out.cast("decimal(18,0)") * rate_out * million
    return F.round(cost, 6).cast("decimal(18,6)")


def usage_rollup(events: DataFrame, mode: str = "sum", order: Sequence[str] = ()) -> DataFrame:
    """Per-step usage plus an ``all_steps`` total over every call.

    ``mode="sum"`` adds the calls of a step; ``mode="last"`` shows its last call in ``order``.
    """
    calls = events.withColumn("step", F.coalesce(F.nullif("step", F.lit("")), F.lit("unknown"))).withColumn(
        "cost_usd", usage_cost(F.col("input_tokens"), F.col("output_tokens"))
    )
    measures = ["input_tokens", "output_tokens", "cost_usd", "response_time_seconds"]
    sums = [F.sum(m).alias(m) for m in measures] + [F.count(F.lit(1)).alias("calls")]
    if mode == "sum":
        per_step = calls.groupBy("step").agg(*sums)
    elif mode == "last":
        last = F.max_by(F.struct(*measures), F.struct(*order))
        per_step = (
            calls.groupBy("step")
            .agg(last.alias("_l"), F.count(F.lit(1)).alias("calls"))
            .select("step", *[F.col(f"_l.{m}").alias(m) for m in measures], "calls")
        )
    else:
        raise ValueError(f"mode must be 'sum' or 'last', got {mode!r}")
    total = calls.agg(*sums).select(F.lit("all_steps").alias("step"), *measures, "calls")
    return (
        per_step.unionByName(total)
        .withColumn("cost_usd", F.round("cost_usd", 6).cast("double"))
        .withColumn("response_time_seconds", F.round("response_time_seconds", 2).cast("double"))
    )
