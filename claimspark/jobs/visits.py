"""Unified member visits from claims, appointment feeds and a scheduling extract.

Dates of service are kept to the day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import codes
from claimspark.functions.compat import after_first, nvl, oracle_concat
from claimspark.functions.dates import as_date, to_effper
from claimspark.operators.joins import flag_exists, join_role, spread_nulls, within_key
from claimspark.operators.project import id_bridge, stack
from claimspark.operators.ranking import keep_first

MEMBER_KEY = ["payer", "lob", "member_id"]

# --- fixed values -----------------------------------------------------------
VISITS_FROM = "2018-01-01"
SWITCH_NPIS = ("1013360528", "1851328199", "1124347182", "1588691828", "1730317769", "1215978960")
VISIT_PLACES = ("Office Visit - PCP Visit", "Hospital", "Office Visit - Specialty Consult", "Clinic")
PROVIDER_COLS = (
    "npi", "lvl2_emp_status", "lvl3_subgroup", "lvl4_practice", "full_name", "default_tin", "pcp_spc", "cms_pcp_spc",
)
LEGACY_STATUSES = ("ARRIVED", "SCHEDULED", "COMPLETED")
VISIT_COLS = (
    "payer", "lob", "member_id", "mrn", "encounter_id", "effper", "date_of_service", "source", "visit_status_type",
    "historical_pcp_npi", "historical_pcp_tin", "historical_pcp_emp_status", "historical_pcp_pod", "historical_pcp_practice",
    "historical_pcp_provider", "historical_prov_pcp_spc", "historical_prov_cms_pcp_spc", "historical_prac_epic_status",
    "current_pcp_npi", "current_pcp_tin", "current_pcp_emp_status", "current_pcp_pod", "current_pcp_practice",
    "current_pcp_provider", "current_prov_pcp_spc", "current_prov_cms_pcp_spc", "current_prac_epic_status",
    "servicing_pcp_npi", "servicing_pcp_tin", "servicing_pcp_emp_status", "servicing_pcp_pod", "servicing_pcp_practice",
    "servicing_pcp_provider", "servicing_prov_pcp_spc", "servicing_prov_cms_pcp_spc", "servicing_prac_epic_status",
    "attributed_at_visit", "currently_attributed", "hist_serv_prov_check", "hist_serv_prac_check", "current_serv_prov_check",
    "current_serv_prac_check", "visit_with_any_spc_pcp", "visit_with_any_cms_spc_pcp", "awv_indicator", "load_dt",
)
# -----------------------------------------------------------------------------


def member_months(raw: DataFrame) -> DataFrame:
    """One row per payer, LOB, member and month: most months first; NPI and TIN settle ties."""
    return keep_first(
        raw,
        [*MEMBER_KEY[::-1], "effper_dt"],
        [
            F.col("member_months").desc_nulls_last(),
            F.col("attributed_pcp_npi").asc_nulls_last(),
            F.col("attributed_pcp_tax_id").asc_nulls_last(),
        ],
    )


def provider_dim(provider: DataFrame) -> DataFrame:
    return provider.select(*PROVIDER_COLS).distinct()


def practice_dim(practice_status: DataFrame) -> DataFrame:
    return practice_status.select("lvl4_practice", "epic_status").distinct()


def active_members(active: DataFrame, xwalk: DataFrame, only_active: bool = False) -> DataFrame:
    """Active members with their token id where the crosswalk has one."""
    rows = active.where(F.col("currently_active") == "Y") if only_active else active
    tokens = xwalk.select("member_id", "member_id_token")
    return rows.join(tokens, "member_id", "left").withColumn("mem_id_ref", nvl(F.col("member_id_token"), F.col("member_id")))


def servicing_provider(claims: DataFrame) -> DataFrame:
    """Servicing or attending NPI and TIN: the switch applies to facility claims only."""
    attending = (
        F.col("servicing_npi").isin(*SWITCH_NPIS) | (F.col("claim_place_of_service") == "Hospital")
    ) & (F.col("claim_type") == "Facility")
    return claims.withColumn(
        "servicing_pcp_npi", F.when(attending, F.col("attending_npi")).otherwise(F.col("servicing_npi"))
    ).withColumn("servicing_pcp_tin", F.when(attending, F.col("attending_tin")).otherwise(F.col("servicing_tin")))


def claim_visits(header: DataFrame, lines: DataFrame) -> DataFrame:
    base = header.where(
        (F.col("include_flag") == "Y")
        & F.col("claim_type").isin("Professional", "Facility")
        & F.col("claim_category").isin("Professional", "Outpatient")
        & F.col("claim_place_of_service").isin(*VISIT_PLACES)
        & F.col("ip_episode_key").isNull()
        & F.col("ed_episode_key").isNull()
        & (F.col("date_of_service") >= as_date(VISITS_FROM))
    )
    wellness = lines.where((F.col("include_flag") == "Y") & F.col("service_code").isin(*codes.WELLNESS_SERVICES))
    key = {k: k for k in (*MEMBER_KEY, "claim_id")}
    flagged = flag_exists(servicing_provider(base), wellness, key, "awv_indicator", "Y", "N")
    return flagged.select(
        *MEMBER_KEY,
        F.col("pri_mrn").alias("mrn"),
        F.col("claim_id").alias("encounter_id"),
        "effper",
        F.to_date("date_of_service").alias("date_of_service"),
        F.lit("CLAIMSTAR").alias("source"),
        F.lit("ARRIVED").alias("visit_status_type"),
        "servicing_pcp_npi",
        "servicing_pcp_tin",
        "awv_indicator",
    )


def encounter_reasons(visit_reason: DataFrame, reason_name: DataFrame) -> DataFrame:
    names = reason_name.select(F.col("reason_visit_id").alias("enc_reason_id"), "reason_visit_name")
    return visit_reason.join(names, "enc_reason_id", "left").select(
        "pat_enc_csn_id", codes.appt_reason(F.col("reason_visit_name")).alias("reason")
    )


def appointments(t: Mapping[str, DataFrame]) -> DataFrame:
    """Two appointment feeds in one shape, from 2018 on. A visit with several reasons gives several rows."""
    reasons = encounter_reasons(t["visit_reason"], t["reason_name"])
    since = F.to_date("appt_dttm") >= as_date(VISITS_FROM)
    access = (
        t["patient_access"].where(since)
        .join(reasons, "pat_enc_csn_id", "left")
        .select(
            F.col("mrn").cast("string").alias("mrn"),
            F.to_date("appt_dttm").alias("appt_dt"),
            F.col("pat_enc_csn_id").cast("string").alias("visit_id"),
            F.upper("appt_status_name").alias("status"),
            "npi",
            "reason",
            F.lit("MV_DM_PATIENT_ACCESS").alias("source"),
        )
    )
    patients = t["patient"].select("pat_id", "y_mrn").distinct()
    providers = t["provider_id"].select("prov_id", "npi").distinct()
    statuses = t["appt_status"].select("appt_status_c", "name")
    scheduled = (
        t["sched_appt"].where(since)
        .join(patients, "pat_id", "left")
        .join(providers, "prov_id", "left")
        .join(statuses, "appt_status_c", "left")
        .join(reasons, "pat_enc_csn_id", "left")
        .select(
            F.col("y_mrn").cast("string").alias("mrn"),
            F.to_date("appt_dttm").alias("appt_dt"),
            F.col("pat_enc_csn_id").cast("string").alias("visit_id"),
            F.upper("name").alias("status"),
            "npi",
            "reason",
            F.lit("F_SCHED_APPT").alias("source"),
        )
    )
    return stack([access, scheduled])


def identifier_bridge(facts: DataFrame, header: DataFrame, which: Column) -> DataFrame:
    """Members by identifier: member facts plus the MRNs seen on claims; fan-out is kept."""
    known = facts.where(which & (F.col("payer") != "ANY") & (F.col("fact") != "0")).select(*MEMBER_KEY, "fact")
    seen = header.where((F.col("date_of_service") >= as_date(VISITS_FROM)) & F.col("pri_mrn").isNotNull()).select(
        *MEMBER_KEY, "pri_mrn"
    )
    return id_bridge(known, seen)


def appointment_visits(t: Mapping[str, DataFrame]) -> DataFrame:
    bridge = identifier_bridge(t["fact_member"], t["claim_header"], F.col("fact_shortdescr") == "PRI-MRN")
    appts = appointments(t)
    return appts.join(bridge, spread_nulls(appts["mrn"], appts["visit_id"]) == bridge["fact"], "left").select(
        *MEMBER_KEY,
        "mrn",
        F.col("visit_id").alias("encounter_id"),
        to_effper(F.col("appt_dt")).alias("effper"),
        F.col("appt_dt").alias("date_of_service"),
        "source",
        F.col("status").alias("visit_status_type"),
        F.col("npi").alias("servicing_pcp_npi"),
        F.lit(None).cast("string").alias("servicing_pcp_tin"),
        F.when(F.col("reason") == codes.ANNUAL_LABEL, "Y").otherwise("N").alias("awv_indicator"),
    )


def ryan_visits(t: Mapping[str, DataFrame]) -> DataFrame:
    """Latest load of each appointment; the raw member id is the text after the first underscore."""
    raw = t["ryan_scheduling"].withColumn("appt_dt", F.to_date("apptdate"))
    ties = [F.col(c).asc_nulls_last() for c in raw.columns if c not in ("identifier1", "identifier2", "appt_dt", "load_date")]
    latest = keep_first(
        raw, ["identifier1", "identifier2", "appt_dt"], [F.to_date("load_date").desc_nulls_last(), *ties]
    ).where(F.col("appt_dt") >= as_date(VISITS_FROM))
    latest = latest.withColumn("raw_member_id", after_first(F.col("identifier2"), "_"))
    bridge = identifier_bridge(t["fact_member"], t["claim_header"], F.col("fact_category") == "Member Identifiers")
    members = t["member"].select(*MEMBER_KEY, F.col("pri_mrn").alias("mrn"))
    return (
        latest.join(bridge, spread_nulls(F.col("raw_member_id"), F.col("identifier1")) == F.col("fact"), "left")
        .join(members, MEMBER_KEY, "left")
        .select(
            "payer",
            "lob",
            nvl(F.col("member_id"), F.col("raw_member_id")).alias("member_id"),
            "mrn",
            oracle_concat(
                F.col("identifier1"), F.lit("~"), F.col("identifier2"), F.lit("~"), F.date_format("appt_dt", "yyyy-MM-dd")
            ).alias("encounter_id"),
            to_effper(F.col("appt_dt")).alias("effper"),
            F.col("appt_dt").alias("date_of_service"),
            F.lit("RYAN SCHEDULING").alias("source"),
            F.col("apptstatus").alias("visit_status_type"),
            F.col("apptprovidernpi").alias("servicing_pcp_npi"),
            F.lit(None).cast("string").alias("servicing_pcp_tin"),
            F.lit(None).cast("string").alias("awv_indicator"),
        )
    )


def _epic_label(npi: Column, status: Column) -> Column:
    return F.when(npi.isNotNull() & status.isNull(), "NON-EPIC").otherwise(status)


def _yes(cond: Column) -> Column:
    return F.when(cond, "Y").otherwise("N")


def attribute_visits(
    base: DataFrame, months: DataFrame, providers: DataFrame, practices: DataFrame, ext: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Add historical, current and servicing provider attributes and the attribution flags.

    What goes by member, its current provider and month included, is put together once a member, and historical providers
    once a member and month, so the visits move twice: by servicing provider while they are narrow, and by member.
    """
    c = F.col
    pcols = ["lvl2_emp_status", "lvl3_subgroup", "lvl4_practice", "full_name", "pcp_spc", "cms_pcp_spc"]
    key = ["member_id", "lob", "_payer"]
    month_cols = months.select(
        c("payer").alias("_payer"),
        "lob",
        "member_id",
        c("effper").alias("_effper"),
        c("attributed_pcp_npi").alias("historical_pcp_npi"),
        c("attributed_pcp_tax_id").alias("historical_pcp_tin"),
        "member_months",
    )
    month_cols = join_role(month_cols, providers, c("historical_pcp_npi"), "npi", "h", pcols, "member_id")
    month_cols = join_role(month_cols, practices, c("h_lvl4_practice"), "lvl4_practice", "h", ["epic_status"], "member_id")
    ext_cols = ext.select(
        c("payer").alias("_payer"),
        "lob",
        c("mem_id_ref").alias("member_id"),
        "currently_active",
        c("attributed_pcp_npi").alias("ext_npi"),
        "pcp_lvl3_pod",
        "pcp_lvl4_practice",
        "latest_active_month",
    )
    current_month = months.select(
        c("payer").alias("_payer"),
        "lob",
        "member_id",
        c("effper").alias("latest_active_month"),
        c("attributed_pcp_tax_id").alias("current_pcp_tin"),
    )
    ext_cols = ext_cols.join(current_month, [*key, "latest_active_month"], "left").drop("latest_active_month")
    ext_cols = join_role(ext_cols, providers, c("ext_npi"), "npi", "c", pcols, "member_id")
    ext_cols = join_role(ext_cols, practices, c("pcp_lvl4_practice"), "lvl4_practice", "c", ["epic_status"], "member_id")
    # visits without a member, provider or practice are common, and must not gather in one task
    salt = "encounter_id"
    df = base.withColumn("_payer", spread_nulls(c("payer"), c(salt)))
    df = join_role(df, providers, c("servicing_pcp_npi"), "npi", "s", pcols, salt)
    df = join_role(df, practices, c("s_lvl4_practice"), "lvl4_practice", "s", ["epic_status"], salt)
    df = within_key(df.join(ext_cols, key, "left"), month_cols, key, "effper", "_effper")
    current_npi = F.when(c("currently_active") == "Y", c("ext_npi"))

    def role(prefix: str, out: str) -> dict[str, Column]:
        return {
            f"{out}_pcp_emp_status": c(f"{prefix}_lvl2_emp_status"),
            f"{out}_pcp_pod": c(f"{prefix}_lvl3_subgroup"),
            f"{out}_pcp_practice": c(f"{prefix}_lvl4_practice"),
            f"{out}_pcp_provider": c(f"{prefix}_full_name"),
            f"{out}_prov_pcp_spc": c(f"{prefix}_pcp_spc"),
            f"{out}_prov_cms_pcp_spc": c(f"{prefix}_cms_pcp_spc"),
        }

    made = {
        **role("h", "historical"),
        "historical_prac_epic_status": _epic_label(c("historical_pcp_npi"), c("h_epic_status")),
        **role("c", "current"),
        "current_pcp_npi": current_npi,
        "current_pcp_pod": c("pcp_lvl3_pod"),
        "current_pcp_practice": c("pcp_lvl4_practice"),
        "current_prac_epic_status": _epic_label(c("ext_npi"), c("c_epic_status")),
        **role("s", "servicing"),
        "servicing_prac_epic_status": _epic_label(c("servicing_pcp_npi"), c("s_epic_status")),
        "attributed_at_visit": _yes(nvl(c("member_months"), 0) > 0),
        "currently_attributed": nvl(c("currently_active"), "N"),
        "hist_serv_prov_check": _yes(nvl(c("historical_pcp_npi"), "x") == c("servicing_pcp_npi")),
        "hist_serv_prac_check": _yes(c("h_lvl4_practice") == c("s_lvl4_practice")),
        "current_serv_prov_check": _yes(current_npi == c("servicing_pcp_npi")),
        "current_serv_prac_check": _yes(c("c_lvl4_practice") == c("s_lvl4_practice")),
        "visit_with_any_spc_pcp": _yes(c("s_pcp_spc") == "PCP"),
        "visit_with_any_cms_spc_pcp": _yes(c("s_cms_pcp_spc") == "PCP"),
        "load_dt": as_date(as_of),
    }
    # with the spread payer: the rows lie by member, and it lets a distinct find them there
    return df.select("_payer", *[made[n].alias(n) if n in made else c(n) for n in VISIT_COLS])


def unified_visits(t: Mapping[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """The 46-column visit table; claims keep repeats, the two scheduling sources are made distinct."""
    months = member_months(t["member_months"])
    providers, practices = provider_dim(t["provider"]), practice_dim(t["practice_status"])
    everyone = active_members(t["active_members"], t["id_xwalk"])
    active = active_members(t["active_members"], t["id_xwalk"], only_active=True)
    claims = attribute_visits(claim_visits(t["claim_header"], t["fact_service"]), months, providers, practices, everyone, as_of)
    scheduled = stack([appointment_visits(t), ryan_visits(t)])
    seen = attribute_visits(scheduled, months, providers, practices, active, as_of).distinct()
    return stack([claims, seen]).drop("_payer")


def legacy_visits(visits: DataFrame) -> DataFrame:
    return visits.where(F.col("visit_status_type").isin(*LEGACY_STATUSES))
