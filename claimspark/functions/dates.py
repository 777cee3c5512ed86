"""Date helpers: period labels, month arithmetic, guarded text dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def to_effper(col: Column) -> Column:
    """``yyyy-MM`` label of a date."""
    return F.date_format(col, "yyyy-MM")


def period_label(start: Column, end: Column) -> Column:
    return F.concat(F.date_format(start, "MM/dd/yyyy"), F.lit(" - "), F.date_format(end, "MM/dd/yyyy"))


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def parse_yyyymmdd(col: Column) -> Column:
    """``yyyyMMdd`` text; the all-zero marker and unreadable text become NULL."""
    return F.try_to_timestamp(F.nullif(col, F.lit("00000000")), F.lit("yyyyMMdd")).cast("date")


def los_days(discharge: Column, admit: Column) -> Column:
    return F.date_diff(discharge, admit)


def intnx(col: Column, unit: str, n: int, align: str, week_start: str = "sun") -> Column:
    """Shift by ``n`` months or weeks and align to the beginning (``b``) or end (``e``)."""
    unit, align = unit.lower(), align.lower()
    if align not in ("b", "e"):
        raise ValueError(f"align must be 'b' or 'e', got {align!r}")
    if unit == "month":
        shifted = F.add_months(col, n)
        return F.trunc(shifted, "MM") if align == "b" else F.last_day(shifted)
    if unit == "week":
        shifted = F.date_add(col, 7 * n)
        if week_start == "sun":
            first = F.date_sub(shifted, F.dayofweek(shifted) - 1)
        elif week_start == "mon":
            first = F.trunc(shifted, "week")
        else:
            raise ValueError(f"week_start must be 'sun' or 'mon', got {week_start!r}")
        return first if align == "b" else F.date_add(first, 6)
    raise ValueError(f"unit must be 'month' or 'week', got {unit!r}")


def stamp_load(df, as_of: dt.date | str | None = None, name: str = "load_date"):
    """Add the load stamp: a given date, or the current timestamp."""
    return df.withColumn(name, F.current_timestamp() if as_of is None else as_date(as_of))
