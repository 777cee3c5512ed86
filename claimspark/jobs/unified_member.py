"""Member reporting: member months per reporting window with running visit measures.

Visits are summed per member and month before anything is joined or windowed, so a running
window never holds more rows than a member has months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.functions.compat import nvl
from claimspark.functions.dates import as_date, month_start, period_label
from claimspark.jobs.visits import MEMBER_KEY, active_members, member_months, practice_dim, provider_dim
from claimspark.operators.joins import join_role, null_tolerant_join, range_join
from claimspark.operators.project import with_rolling_period
from claimspark.operators.ranking import keep_best
from claimspark.session import stored

PERSON = [*MEMBER_KEY, "mrn"]
FLAGS = ("pcp_npi_visit", "pcp_practice_visit", "pcp_pod_visit", "mt_sinai_visit")
COUNTS = ("count_pcp_npi_visits", "count_pcp_practice_visits", "count_any_pcp_npi_visits", "count_any_cms_pcp_npi_visits")

# --- fixed values -----------------------------------------------------------
UPCOMING_DAYS = 180
UPCOMING = ("upcoming_appointments_rolling", "upcoming_appointments_ytd", "upcoming_appointments_mssp")
MEMBER_COLS = (
    "reporting_year", "reporting_month", "reporting_date", "reporting_period", "payer", "lob", "member_id", "mrn", "pcp_npi",
    "pcp_provider", "pcp_emp_status", "pcp_spc", "cms_pcp_spc", "pcp_pod", "pcp_practice", "epic_status",
    "provider_attribution_type", "member_months", "reporting_window", "currently_attributed", *FLAGS, *COUNTS,
    *UPCOMING, "load_dt",
)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportWindow:
    """One reporting window: its period name, first year, and how the running measures restart."""

    name: str
    from_year: str | None = None
    restart_per_period: bool = True
    practice_periods: str | None = None  # periods that define the member's historical practices


# The MSSP window takes its historical practices from the calendar-year periods, as the legacy job does.
WINDOWS = (
    ReportWindow("Rolling 12", None, restart_per_period=False),
    ReportWindow("Calendar Year", "2019"),
    ReportWindow("MSSP", "2019", practice_periods="Calendar Year"),
)


def rolling_bounds(previous: DataFrame | None, as_of: dt.date, legacy_bounds: bool = False) -> tuple[dt.date, dt.date]:
    """First and last day of the rolling window, read before the target is overwritten.

    With a previous run, both move on by a month once a new month has begun. Without one, the
    start is twelve months before this month (``legacy_bounds``: 365 days before it).
    One aggregate row is collected.
    """
    spark = previous.sparkSession if previous is not None else None
    this_month = as_of.replace(day=1)
    if legacy_bounds:
        start = this_month - dt.timedelta(days=365)
    else:
        start = this_month.replace(year=this_month.year - 1)
    end = _month_end(_add_months(start, 11))
    if spark is None:
        return start, end
    row = bounds_frame(previous, as_of).first()
    return row["window_from"] or start, row["window_to"] or end


def bounds_frame(previous: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The window carried on from the previous run; NULLs when there was none."""
    seen = previous.where(F.upper("reporting_window") == "ROLLING 12").agg(
        F.min("reporting_date").alias("lo"), F.max("reporting_date").alias("hi"), F.max(F.to_date("load_dt")).alias("loaded")
    )
    moved = F.col("loaded") < month_start(as_date(as_of))
    step = lambda c: F.when(moved, F.add_months(c, 1)).otherwise(F.col(c))
    return seen.select(step("lo").alias("window_from"), F.last_day(step("hi")).alias("window_to"))


def _add_months(day: dt.date, n: int) -> dt.date:
    month = day.month - 1 + n
    year, month = day.year + month // 12, month % 12 + 1
    return dt.date(year, month, min(day.day, _month_end(dt.date(year, month, 1)).day))


def _month_end(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def enrolled_months(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Member months above zero, once per MRN fact of the member."""
    mrns = facts.where(F.col("fact_shortdescr") == "PRI-MRN").select(*MEMBER_KEY, F.col("fact").alias("mrn")).distinct()
    kept = member_months(raw).where(nvl(F.col("member_months"), 0) > 0)
    return kept.join(mrns, MEMBER_KEY, "left").select(
        *PERSON, "effper_dt", "member_months", F.col("attributed_pcp_npi").alias("pcp_npi")
    )


def monthly_visits(visits: DataFrame, periods: DataFrame, histories: Sequence[str]) -> DataFrame:
    """Visit flags and counts per person and month: one row each, whatever the number of visits.

    For each period name in ``histories`` there is one ``known_practice_<i>`` flag: the servicing
    practice was a historical practice of the person in some period of that name.
    """
    c = F.col
    known = [f"known_practice_{i}" for i in range(len(histories))]
    past = visits.where(c("historical_pcp_practice").isNotNull()).select(*PERSON, "month", "historical_pcp_practice").distinct()
    spans = periods.where(c("measurement_period_desc").isin(*histories))
    past = (
        range_join(past, spans, "month")
        .groupBy(*PERSON, c("historical_pcp_practice").alias("past_practice"))
        .agg(*[F.max(F.when(c("measurement_period_desc") == h, 1)).alias(k) for h, k in zip(histories, known)])
    )
    keys = {k: k for k in PERSON} | {"servicing_pcp_practice": "past_practice"}
    rows = null_tolerant_join(visits, past, keys, never_on_null=["servicing_pcp_practice"])

    def same(what: str) -> Column:
        return F.when(c(f"servicing_{what}") == c(f"historical_{what}"), 1).otherwise(0)

    def is_pcp(name: str) -> Column:
        return F.when(c(name) == "PCP", 1).otherwise(0)

    return rows.groupBy(*PERSON, "month").agg(
        F.max(same("pcp_npi")).alias("pcp_npi_visit"),
        F.max(same("pcp_practice")).alias("pcp_practice_visit"),
        F.max(same("pcp_pod")).alias("pcp_pod_visit"),
        *[F.max(F.coalesce(k, F.lit(0))).alias(k) for k in known],
        F.sum(same("pcp_npi")).alias("count_pcp_npi_visits"),
        F.sum(same("pcp_practice")).alias("count_pcp_practice_visits"),
        F.sum(is_pcp("servicing_prov_pcp_spc")).alias("count_any_pcp_npi_visits"),
        F.sum(is_pcp("servicing_prov_cms_pcp_spc")).alias("count_any_cms_pcp_npi_visits"),
        F.lit(1).alias("_seen"),
    )


def running_visit_measures(df: DataFrame, keys: list, order: str) -> DataFrame:
    """Running flags (max) and counts (sum) up to and including each month.

    The frame is by month value, so all rows of a month share the end-of-month figure, which is
    the row the legacy job keeps.
    """
    window = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    measures = {n: F.max(nvl(F.col(n), 0)).over(window) for n in FLAGS}
    measures |= {n: F.sum(nvl(F.col(n), 0)).over(window).cast("long") for n in COUNTS}
    return df.withColumns(measures)


def narrow_visits(visits: DataFrame) -> DataFrame:
    """The visit columns the report reads. Three steps scan them, so ``visits`` should be a written table."""
    return visits.select(
        *PERSON, "date_of_service", "visit_status_type", month_start(F.col("date_of_service")).alias("month"),
        "servicing_pcp_npi", "historical_pcp_npi", "servicing_pcp_practice", "historical_pcp_practice", "servicing_pcp_pod",
        "historical_pcp_pod", "servicing_prov_pcp_spc", "servicing_prov_cms_pcp_spc",
    )


def window_periods(periods: DataFrame, windows: Sequence[ReportWindow]) -> DataFrame:
    """Periods of the requested windows from their first year on."""
    c = F.col
    wanted = F.lit(False)
    for w in windows:
        mine = c("measurement_period_desc") == w.name
        wanted = wanted | ((mine & (c("effyear") >= w.from_year)) if w.from_year else mine)
    return periods.where(wanted)


def unified_member(
    t: Mapping[str, DataFrame],
    visits: DataFrame,
    bounds: tuple[dt.date, dt.date],
    as_of: dt.date | str,
    windows: Sequence[ReportWindow] = WINDOWS,
) -> DataFrame:
    """All reporting windows in one pass, before duplicate MRNs are resolved."""
    c = F.col
    periods = with_rolling_period(t["meas_period"], as_date(bounds[0]), as_date(bounds[1]))
    mine = window_periods(periods, windows)
    histories = sorted({w.practice_periods or w.name for w in windows})

    months = stored(enrolled_months(t["member_months"], t["fact_member"]), "months")  # read for the rows and for the calendar
    seen = monthly_visits(visits, periods, histories)
    df = null_tolerant_join(months, seen, {**{k: k for k in PERSON}, "effper_dt": "month"}, never_on_null=["effper_dt"])

    upcoming = (
        visits.where(
            (c("visit_status_type") == "SCHEDULED")
            & c("date_of_service").between(as_date(as_of), F.date_add(as_date(as_of), UPCOMING_DAYS))
            & F.coalesce("member_id", "mrn").isNotNull()
        )
        .select(*MEMBER_KEY, c("mrn").alias("visit_mrn"))
        .distinct()
        .withColumn("_upcoming", F.lit(1))
    )
    # matched on the visit's MRN: a month without visits only meets scheduled rows without MRN
    df = df.withColumn("_visit_mrn", F.when(c("_seen") == 1, c("mrn")))
    df = null_tolerant_join(df, upcoming, {**{k: k for k in MEMBER_KEY}, "_visit_mrn": "visit_mrn"})

    df = range_join(df, mine, "effper_dt").withColumn("reporting_period", period_label(c("start_dt"), c("end_dt")))
    name = c("measurement_period_desc")
    sinai, restart = F.lit(None).cast("int"), F.lit(None).cast("string")
    for w in windows:
        flag = c(f"known_practice_{histories.index(w.practice_periods or w.name)}")
        sinai = F.when(name == w.name, flag).otherwise(sinai)
        if w.restart_per_period:
            restart = F.when(name == w.name, c("reporting_period")).otherwise(restart)
    df = df.withColumns({"mt_sinai_visit": sinai, "_restart": restart})
    df = running_visit_measures(df, [*PERSON, "measurement_period_desc", "_restart"], "effper_dt")

    # month number inside a period: ranked over the distinct months, not over all rows
    calendar = range_join(months.select("effper_dt").distinct(), mine, "effper_dt").select(
        "measurement_period_desc", period_label(c("start_dt"), c("end_dt")).alias("reporting_period"), "effper_dt"
    ).distinct()
    rank = F.dense_rank().over(Window.partitionBy("measurement_period_desc", "reporting_period").orderBy("effper_dt"))
    calendar = calendar.withColumn("reporting_month", rank)
    df = df.join(calendar, ["measurement_period_desc", "reporting_period", "effper_dt"], "left")

    ext = active_members(t["active_members"], t["id_xwalk"]).select(
        *MEMBER_KEY, c("attributed_pcp_npi").alias("ext_npi"), "currently_active"
    )
    df = df.join(ext, MEMBER_KEY, "left")
    df = join_role(
        df, provider_dim(t["provider"]), c("pcp_npi"), "npi", "p",
        ["full_name", "lvl2_emp_status", "pcp_spc", "cms_pcp_spc", "lvl3_subgroup", "lvl4_practice"],
    )
    df = join_role(df, practice_dim(t["practice_status"]), c("p_lvl4_practice"), "lvl4_practice", "p", ["epic_status"])
    current = c("pcp_npi") == c("ext_npi")
    made = {
        "reporting_year": F.year("effper_dt"),
        "reporting_date": c("effper_dt"),
        "pcp_provider": c("p_full_name"),
        "pcp_emp_status": c("p_lvl2_emp_status"),
        "pcp_spc": c("p_pcp_spc"),
        "cms_pcp_spc": c("p_cms_pcp_spc"),
        "pcp_pod": c("p_lvl3_subgroup"),
        "pcp_practice": c("p_lvl4_practice"),
        "epic_status": c("p_epic_status"),
        "provider_attribution_type": F.when(current, "Currently Attributed").otherwise("Historically Attributed"),
        "reporting_window": name,
        "currently_attributed": nvl(c("currently_active"), "N"),
        "upcoming_appointments_rolling": nvl(c("_upcoming"), 0),
        "upcoming_appointments_ytd": F.lit(0),
        "upcoming_appointments_mssp": F.lit(0),
        "load_dt": as_date(as_of),
    }
    return df.select(*[made[n].alias(n) if n in made else c(n) for n in MEMBER_COLS])


def resolve_duplicates(df: DataFrame) -> DataFrame:
    """Keep the row with the best measures: first per MRN, then across a member's MRNs."""
    key = ["reporting_month", "reporting_date", "reporting_period", "reporting_window", *MEMBER_KEY]
    best = [F.col(n).desc_nulls_first() for n in (*FLAGS, *COUNTS, *UPCOMING)]
    rest = [F.col(n).asc_nulls_last() for n in ("pcp_npi", "pcp_provider", "epic_status", "currently_attributed")]
    return keep_best(
        df, [([*key, nvl(F.col("mrn"), "M")], [*best, *rest]), (key, [*best, F.col("mrn").desc_nulls_last(), *rest])]
    )


def member_reporting(
    t: Mapping[str, DataFrame], visits: DataFrame, as_of: dt.date, previous: DataFrame | None = None, legacy_bounds: bool = False
) -> DataFrame:
    """All three reporting windows, deduplicated."""
    bounds = rolling_bounds(previous, as_of, legacy_bounds)
    return resolve_duplicates(unified_member(t, narrow_visits(visits), bounds, as_of))
