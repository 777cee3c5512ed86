"""Patient-seen visits: enhanced visit table (three branches) and the deduplicated mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions.codes import valid_member
from claimspark.functions.compat import is_flag, to_id, typed_null
from claimspark.functions.dates import as_date
from claimspark.jobs.visits import VISIT_COLS
from claimspark.operators.joins import join_role, semi_filter, spread_nulls, within_key
from claimspark.operators.ranking import keep_best, keep_first, latest_by

# --- fixed values -----------------------------------------------------------
SEEN_FROM = "2019-01-01"
SEEN_FROM_YEAR = 2019
MV, RYAN, CLAIMS = "MV_DM_PATIENT_ACCESS", "RYAN SCHEDULING", "CLAIMSTAR"
SCHEDULED_ENC_TYPE = "50"
RYAN_POD, ONE_MEDICAL_POD = "23 - Ryan Health", "07 - One Medical"
VBC_LOBS = ("Medicare", "MA", "Commercial", "Medicaid")
DROPPED_PAYER = "EMBLEM"
DETAIL_TEXT = (
    "grouper_name", "department_name", "enc_type_c", "enc_type_pos", "proc_code", "proc_code_desc", "prov_name", "prov_title",
    "prov_title_id", "appt_status", "enc_closed_yn",
)
CHECK_COLS = (
    "pc_visit_cmplt_close_yn", "pc_visit_los_code_yn", "pc_visit_prov_type_yn", "pc_visit_grouper_yn", "pc_visit_all_match_yn",
)
# -----------------------------------------------------------------------------

SEEN_COLS = (*VISIT_COLS, "effyear", *DETAIL_TEXT, *CHECK_COLS, "payer_not_chgd", "create_dt")


def standardize_visit(df: DataFrame) -> DataFrame:
    """One spelling of each status, one name for the MSSP payers, the original payer kept."""
    status = (
        F.when(F.col("visit_status_type").isin("CANCELED", "CANCELLED"), "CANCELED")
        .when(F.col("visit_status_type").isin("NO SHOW", "NOSHOW"), "NO SHOW")
        .otherwise(F.col("visit_status_type"))
    )
    payer = F.when(F.col("payer").contains("MSSP"), "MSSP NYMP").otherwise(F.col("payer"))
    return df.withColumns({"payer_not_chgd": F.col("payer"), "visit_status_type": status, "payer": payer})


def visit_check_flags(completed: Column, los: Column, provider: Column, grouper: Column) -> dict[str, Column]:
    """Four checks as 1/0 and their conjunction; an unknown check counts as 0."""
    checks = [is_flag(x) for x in (completed, los, provider, grouper)]
    both = is_flag((checks[0] == 1) & (checks[1] == 1) & (checks[2] == 1) & (checks[3] == 1))
    return dict(zip(CHECK_COLS, [*checks, both]))


def linkable(visits: DataFrame) -> DataFrame:
    """Visits from 2019 on that can be tied to a member and a provider."""
    needed = ("date_of_service", "payer", "lob", "servicing_pcp_npi")
    rows = visits.where((F.col("date_of_service") >= as_date(SEEN_FROM)) & valid_member(F.col("member_id")))
    for name in needed:
        rows = rows.where(F.col(name).isNotNull())
    return rows


def encounter_detail(t: Mapping[str, DataFrame]) -> DataFrame:
    """Encounters with their reference names and the four visit checks."""
    c = F.col
    enc = t["encounter"].where(c("contact_date") >= as_date(SEEN_FROM))
    enc = enc.join(t["department"].select("department_id", "department_name"), "department_id", "left")
    procs = t["procedure"].select(c("proc_id").alias("los_prime_proc_id"), "proc_code", c("proc_name").alias("proc_code_desc"))
    enc = enc.join(procs, "los_prime_proc_id", "left")
    types = t["enc_type"].select(c("disp_enc_type_c").alias("enc_type_c"), c("name").alias("enc_type_pos"))
    enc = enc.join(types, "enc_type_c", "left")
    people = t["ser_provider"].select(c("prov_id").alias("visit_prov_id"), "prov_name", c("provider_type_c").alias("prov_title_id"))
    enc = enc.join(people, "visit_prov_id", "left")
    titles = t["ser_title"].select(c("service_type_c").alias("prov_title_id"), c("title").alias("prov_title"), F.lit(1).alias("_title"))
    enc = enc.join(titles, "prov_title_id", "left").withColumn("prov_title_id", F.when(c("_title") == 1, c("prov_title_id")))
    statuses = t["appt_status"].select("appt_status_c", c("name").alias("appt_status"), c("title").alias("_status_title"))
    enc = enc.join(statuses, "appt_status_c", "left")
    los = t["los_list"].select(c("proc_id").alias("los_prime_proc_id"), F.lit(1).alias("_los"))
    enc = enc.join(los, "los_prime_proc_id", "left")
    kinds = t["provider_type_list"].select(c("provider_type_c").alias("prov_title_id"), F.lit(1).alias("_kind"))
    enc = enc.join(kinds, "prov_title_id", "left")
    groups = t["dept_grouper"].select(c("grouper_records_numeric_id").alias("department_id"), "grouper_name")
    enc = enc.join(groups, "department_id", "left")
    flags = visit_check_flags(
        (c("_status_title") == "COMPLETED") | (c("enc_closed_yn") == "Y"),
        (c("_los") == 1) & (c("enc_type_c") != SCHEDULED_ENC_TYPE),
        c("_kind") == 1,
        c("grouper_name").isNotNull(),
    )
    return enc.select(
        to_id(c("pat_enc_csn_id")).alias("_enc_id"), *DETAIL_TEXT, *[expr.alias(name) for name, expr in flags.items()]
    )


def claim_procedure(lines: DataFrame, excluded: DataFrame, included: DataFrame) -> DataFrame:
    """One procedure code per claim and service date: excluded first, then included, then any."""
    c = F.col
    excl = excluded.select(c("proc_code").alias("excl_code"), c("proc_code_description").alias("_excl_desc"))
    incl = included.select(c("proc_code").alias("incl_code"), c("proc_name").alias("_incl_desc"))
    coded = (
        lines.where(c("service_dt") >= as_date(SEEN_FROM))
        .select("payer", "lob", "member_id", "claim_id", "service_dt", "service_code")
        .join(excl, c("service_code") == c("excl_code"), "left")
        .join(incl, c("service_code") == c("incl_code"), "left")
        .withColumn("proc_code_desc", F.coalesce("_excl_desc", "_incl_desc"))
        .drop("_excl_desc", "_incl_desc")
    )
    return keep_first(
        coded,
        ["member_id", "payer", "lob", "claim_id", "service_dt"],
        [c("excl_code").asc_nulls_last(), c("incl_code").desc_nulls_last(), c("service_code").asc_nulls_last()],
    )


def _finish(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    out = standardize_visit(df).withColumns({"effyear": F.substring("effper", 1, 4), "create_dt": as_date(as_of)})
    return out.select(*SEEN_COLS)


def claim_detail(t: Mapping[str, DataFrame]) -> DataFrame:
    """Professional and outpatient claims at the listed places, with their procedures."""
    c = F.col
    header = semi_filter(
        t["claim_header"].where(
            (c("include_flag") == "Y")
            & c("claim_type").isin("Professional", "Facility")
            & c("claim_category").isin("Professional", "Outpatient")
        ),
        t["place_list"],
        {"claim_place_of_service": "claim_place_of_service"},
    ).select("payer", "lob", "member_id", "claim_id", c("claim_place_of_service").alias("enc_type_pos"))
    codes = claim_procedure(t["fact_service"], t["excluded_list"], t["los_list"])
    return header.join(
        codes.select("payer", "lob", "member_id", "claim_id", c("service_code").alias("proc_code"), "proc_code_desc", "excl_code"),
        ["payer", "lob", "member_id", "claim_id"],
        "left",
    )


def patient_seen_all(visits: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """Appointments with encounter detail, scheduling rows without, claims with procedure detail.

    One pass over the visits: each row looks up the detail of its own source only, in one table for all sources, by a key that
    is spread for rows without detail.
    """
    c = F.col
    of_mv, of_claims = c("source") == MV, c("source") == CLAIMS
    of_ryan = (c("source") == RYAN) & c("visit_status_type").isin("SCHEDULED", "ARRIVED")
    rows = linkable(visits).where(of_mv | of_ryan | of_claims)
    member = ("member_id", "lob", "payer")
    # one table of both kinds of detail: an encounter goes by its id alone, a claim by its member too
    encounters = encounter_detail(t).withColumns({"_id": F.concat(F.lit("E"), c("_enc_id").cast("string")), **{f"_d_{n}": F.lit("") for n in member}})
    coded = claim_detail(t).select(
        F.concat(F.lit("C"), "claim_id").alias("_id"), *[c(n).alias(f"_d_{n}") for n in member], "enc_type_pos", "proc_code", "proc_code_desc", "excl_code"
    )
    detail = encounters.drop("_enc_id").unionByName(coded, allowMissingColumns=True)
    detail = detail.select("_id", *[f"_d_{n}" for n in member], "excl_code", *[c(n).alias(f"_e_{n}") for n in (*DETAIL_TEXT, *CHECK_COLS)])
    wanted = F.when(of_mv, F.concat(F.lit("E"), to_id(c("encounter_id")).cast("string"))).when(of_claims, F.concat(F.lit("C"), "encounter_id"))
    same = spread_nulls(wanted, c("encounter_id")) == c("_id")
    for name in member:
        same = same & (F.when(of_claims, c(name)).otherwise("") == c(f"_d_{name}"))
    joined = rows.join(detail, same, "left")
    not_excluded = is_flag(c("excl_code").isNull())
    # visits without an encounter have no checks, but the conjunction is 0 for them
    encounters = {n: c(f"_e_{n}") for n in (*DETAIL_TEXT, *CHECK_COLS)}
    encounters["pc_visit_all_match_yn"] = F.coalesce("_e_pc_visit_all_match_yn", F.lit(0))
    claims = {
        **{n: c(f"_e_{n}") for n in ("enc_type_pos", "proc_code", "proc_code_desc")},
        "appt_status": F.lit("Completed"),
        "enc_closed_yn": F.lit("Y"),
        "pc_visit_cmplt_close_yn": F.lit(1),
        "pc_visit_los_code_yn": not_excluded,
        "pc_visit_all_match_yn": not_excluded,
    }

    def value(name: str) -> Column:
        own = F.when(of_mv, encounters[name])
        return own.when(of_claims, claims[name]) if name in claims else own

    return _finish(joined.withColumns({n: value(n) for n in encounters}), as_of)


def attributed_match(practice: Column, pod: Column, npi: Column) -> Column:
    """1 when the attributed practice or NPI is the servicing one and the visit qualifies."""
    c = F.col
    same_practice = (
        (F.upper(practice) == F.upper(c("servicing_pcp_practice")))
        & practice.isNotNull()
        & ~pod.like("%Requires Investigation%")
    )
    qualifies = (
        (c("pc_visit_los_code_yn") == 1)
        & (c("pc_visit_cmplt_close_yn") == 1)
        & (((c("source") == MV) & (c("pc_visit_prov_type_yn") == 1)) | (c("source") == CLAIMS))
    )
    return is_flag((same_practice | (npi == c("servicing_pcp_npi"))) & qualifies)


def match_flags(df: DataFrame) -> DataFrame:
    c = F.col
    sides = ("payer_current", "payer_effper", "epic")
    for side in sides:
        df = df.withColumn(f"{side}_match", attributed_match(c(f"{side}_lvl4_practice"), c(f"{side}_pod"), c(f"{side}_npi")))
    done = (c("pc_visit_los_code_yn") == 1) & (c("pc_visit_cmplt_close_yn") == 1)
    by_mv = (c("source") == MV) & (c("pc_visit_prov_type_yn") == 1)
    pod = c("servicing_pcp_pod")
    shared_pod = (pod == c("epic_pod")) | (pod == c("payer_effper_pod")) | (pod == c("payer_current_pod"))
    df = df.withColumns(
        {
            "pc_grouper_match": is_flag(by_mv & done & (c("pc_visit_grouper_yn") == 1)),
            "ryan_match": is_flag((pod == RYAN_POD) & shared_pod & done & (c("source") == CLAIMS)),
            "one_med_match": is_flag((pod == ONE_MEDICAL_POD) & shared_pod & done & (by_mv | (c("source") == CLAIMS))),
            "historic_def_match": is_flag((c("servicing_prov_pcp_spc") == "PCP") & (c("vbc_flag") == "Y")),
        }
    )
    names = [f"{s}_match" for s in sides] + ["pc_grouper_match", "ryan_match", "one_med_match"]
    return df.withColumn("any_match", F.greatest(*[c(n) for n in names]))


def schedule_flags(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Completed, scheduled, in the future, and within 180 days of ``as_of``."""
    c = F.col
    today = as_date(as_of)
    done = (c("pc_visit_los_code_yn") == 1) & (c("pc_visit_cmplt_close_yn") == 1)
    ryan = (c("source") == RYAN) & c("visit_status_type").isin("ARRIVED", "SCHEDULED")
    epic = (
        (c("source") == MV)
        & (c("enc_type_c") == SCHEDULED_ENC_TYPE)
        & (c("visit_status_type") == "SCHEDULED")
        & c("grouper_name").isNotNull()
    )
    ahead = c("date_of_service") > today
    near = ahead & (c("date_of_service") <= F.date_add(today, 180))
    return df.withColumns(
        {
            "completed_visit_yn": is_flag(done & (((c("source") == MV) & (c("pc_visit_prov_type_yn") == 1)) | (c("source") == CLAIMS))),
            "scheduled_visit_yn": is_flag((ryan & ahead) | epic),
            "sched_visit_future_yn": is_flag((ryan | epic) & ahead),
            "scheduled_wi_180days_yn": is_flag((ryan | epic) & near),
        }
    )


def exclusion_flags(df: DataFrame) -> DataFrame:
    """Exclusion markers, 1 or NULL. The source test binds only to the first half of its condition."""
    c = F.col

    def failed(name: str) -> Column:
        return c(name).isNull() | (c(name) == 0)

    prov = ((c("source") == MV) & c("pc_visit_prov_type_yn").isNull()) | (c("pc_visit_prov_type_yn") == 0)
    closed = c("pc_visit_cmplt_close_yn").isNull() | (c("pc_visit_cmplt_close_yn") == 1)
    return df.withColumns(
        {
            "excluded_epic_prov_type": F.when(prov, 1),
            "excluded_epic_enc_type": typed_null("int"),
            "excluded_proc_code": F.when(failed("pc_visit_los_code_yn"), 1),
            "excluded_pc_grouper": F.when(failed("pc_visit_grouper_yn"), 1),
            "excluded_vis_compl_clsd": F.when(closed, 1),
            "excluded_any_reason": F.when(failed("pc_visit_all_match_yn"), 1),
        }
    )


def dedup_encounters(df: DataFrame) -> DataFrame:
    """One row per encounter, then one per member, day, provider and completeness.

    Descending order puts NULLs first unless said otherwise. The last keys settle ties that the
    legacy job leaves open.
    """
    c = F.col
    ties = [c(n).asc_nulls_last() for n in ("proc_code", "proc_code_desc", "enc_type_pos", "visit_status_type", "pri_mrn")]
    day = ["member_id", "lob", "payer", "date_of_service", "servicing_pcp_npi"]
    first = [c(n).desc_nulls_first() for n in ("any_match", "pc_visit_all_match_yn", "awv_indicator", "source")]
    second = [c("pc_visit_all_match_yn").desc_nulls_last(), c("source").desc_nulls_first(), c("encounter_id").asc_nulls_last()]
    return keep_best(
        df, [([*day, "encounter_id"], [*first, *ties]), ([*day, "pc_visit_cmplt_close_yn"], [*second, *ties])]
    )


# --- fixed values: the columns of the mart and of its published copy, in order -----
MART_COLS = (
    "payer", "lob", "member_id", "pri_mrn", "encounter_id", "effper", "date_of_service", "source",
    "visit_status_type", "servicing_pcp_npi", "servicing_pcp_tin", "servicing_pcp_emp_status", "servicing_pcp_pod",
    "servicing_pcp_practice", "servicing_pcp_provider", "effmonth", "effyear", "prac_emp_status", "pcp_emp_status",
    "crnt_pyr", "vbc_flag", "death_dt", "payer_effper_npi", "payer_effper_lvl4_practice", "payer_effper_full_name",
    "payer_effper_pod", "payer_effper_prac_emp_status", "payer_current_npi", "payer_current_lvl4_practice",
    "payer_current_full_name", "payer_current_pod", "payer_current_prac_emp_status", "epic_npi", "epic_lvl4_practice",
    "epic_full_name", "epic_pod", "epic_prac_emp_status", "enc_closed_yn", "pc_grouper_name", "epic_dept",
    "enc_type_c", "enc_type_pos", "proc_code", "proc_code_desc", "prov_title", "prov_title_id",
    "excluded_epic_prov_type", "scheduled_visit_yn", "sched_visit_future_yn", "scheduled_wi_180days_yn",
    "pc_visit_cmplt_close_yn", "pc_visit_los_code_yn", "pc_visit_prov_type_yn", "pc_visit_grouper_yn",
    "pc_visit_all_match_yn", "payer_current_match", "payer_effper_match", "epic_match", "pc_grouper_match",
    "ryan_match", "one_med_match", "any_match", "historic_def_match", "servicing_prov_pcp_spc",
    "servicing_prov_cms_pcp_spc", "servicing_prac_epic_status", "historical_pcp_npi", "historical_pcp_tin",
    "historical_pcp_emp_status", "historical_pcp_pod", "historical_pcp_practice", "historical_pcp_provider",
    "historical_prov_pcp_spc", "historical_prov_cms_pcp_spc", "historical_prac_epic_status", "current_pcp_npi",
    "current_pcp_tin", "current_pcp_emp_status", "current_pcp_pod", "current_pcp_practice", "current_pcp_provider",
    "current_prov_pcp_spc", "current_prov_cms_pcp_spc", "current_prac_epic_status", "attributed_at_visit",
    "currently_attributed", "hist_serv_prov_check", "hist_serv_prac_check", "current_serv_prov_check",
    "current_serv_prac_check", "visit_with_any_spc_pcp", "visit_with_any_cms_spc_pcp", "awv_indicator",
    "data_update_dt", "dos_npi_rn", "enc_rn",
)
COPY_COLS = (
    "payer", "lob", "member_id", "pri_mrn", "encounter_id", "effper", "date_of_service", "source",
    "visit_status_type", "servicing_pcp_npi", "servicing_pcp_tin", "servicing_pcp_emp_status", "servicing_pcp_pod",
    "servicing_pcp_practice", "servicing_pcp_provider", "effmonth", "effyear", "pc_grouper_name", "epic_dept",
    "enc_type_c", "enc_type_pos", "proc_code", "proc_code_desc", "prov_title", "prov_title_id", "prac_emp_status",
    "pcp_emp_status", "crnt_pyr", "vbc_flag", "death_dt", "payer_effper_npi", "payer_effper_lvl4_practice",
    "payer_effper_full_name", "payer_effper_pod", "payer_effper_prac_emp_status", "payer_current_npi",
    "payer_current_lvl4_practice", "payer_current_full_name", "payer_current_pod", "payer_current_prac_emp_status",
    "epic_npi", "epic_lvl4_practice", "epic_full_name", "epic_pod", "epic_prac_emp_status", "excluded_epic_prov_type",
    "excluded_epic_enc_type", "excluded_proc_code", "excluded_any_reason", "completed_visit_yn", "scheduled_visit_yn",
    "sched_visit_future_yn", "scheduled_wi_180days_yn", "payer_current_match", "payer_effper_match", "epic_match",
    "pc_grouper_match", "ryan_match", "one_med_match", "any_match", "historic_def_match", "servicing_prov_pcp_spc",
    "servicing_prov_cms_pcp_spc", "servicing_prac_epic_status", "historical_pcp_npi", "historical_pcp_tin",
    "historical_pcp_emp_status", "historical_pcp_pod", "historical_pcp_practice", "historical_pcp_provider",
    "historical_prov_pcp_spc", "historical_prov_cms_pcp_spc", "historical_prac_epic_status", "current_pcp_npi",
    "current_pcp_tin", "current_pcp_emp_status", "current_pcp_pod", "current_pcp_practice", "current_pcp_provider",
    "current_prov_pcp_spc", "current_prov_cms_pcp_spc", "current_prac_epic_status", "attributed_at_visit",
    "currently_attributed", "hist_serv_prov_check", "hist_serv_prac_check", "current_serv_prov_check",
    "current_serv_prac_check", "visit_with_any_spc_pcp", "visit_with_any_cms_spc_pcp", "awv_indicator",
    "s0_encounter_table", "s0_encounter_table_update", "s1_encounter_table", "s1_encounter_table_update", "orig_rn",
    "data_update_dt", "enc_closed_yn", "pc_visit_all_match_yn", "pc_visit_cmplt_close_yn", "pc_visit_grouper_yn",
    "pc_visit_los_code_yn", "pc_visit_prov_type_yn", "dos_npi_rn", "enc_rn",
)
# columns of the copy that the mart does not fill
COPY_ONLY = {
    "excluded_epic_enc_type": "int",
    "excluded_proc_code": "int",
    "excluded_any_reason": "int",
    "completed_visit_yn": "int",
    "s0_encounter_table": "string",
    "s0_encounter_table_update": "string",
    "s1_encounter_table": "string",
    "s1_encounter_table_update": "string",
    "orig_rn": "int",
}
# -----------------------------------------------------------------------------


def mart_rows(seen: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """Visits with attribution, provider and death attributes and all flags, before deduplication."""
    c = F.col
    key = ["member_id", "lob", "payer"]
    base = seen.where(
        c("payer").isNotNull()
        & c("lob").isin(*VBC_LOBS)
        & ~c("member_id").like("00000000%00000000")
        & (
            ((c("source") == RYAN) & c("visit_status_type").isin("SCHEDULED", "ARRIVED"))
            | c("source").isin(MV, CLAIMS)
        )
        & (c("effyear").try_cast("int") >= SEEN_FROM_YEAR)
    ).withColumnRenamed("mrn", "pri_mrn")
    reporting = t["management_reporting"]
    provider = t["provider"].select(
        "npi",
        "lvl4_practice",
        "full_name",
        c("lvl3_subgroup").alias("pod"),
        c("lvl5_prac_emp_status").alias("prac_emp_status"),
    )

    def with_provider(rows: DataFrame, side: str, salt: str) -> DataFrame:
        return join_role(rows, provider, c(f"{side}_npi"), "npi", side, ["lvl4_practice", "full_name", "pod", "prac_emp_status"], salt)

    # providers are looked up once a member, member and month, or MRN, not once a visit
    effper = reporting.where(c("effyear") >= SEEN_FROM_YEAR).select(
        *key, c("effper").alias("_effper"), "prac_emp_status", "pcp_emp_status", "crnt_pyr", "vbc_flag", c("npi").alias("payer_effper_npi")
    )
    ties = [F.col(n).asc_nulls_last() for n in ("npi", "prac_emp_status")]
    current = latest_by(reporting.select(*key, "effper", "npi", "prac_emp_status"), key, "effper", ties).select(
        *key, c("npi").alias("payer_current_npi")
    )
    epic = t["epic_pcp"].select(c("mrn").alias("_mrn"), c("npi").alias("epic_npi"))
    death = t["member"].select(*key, "death_dt")
    # the joins by member come last: the rows then lie where the ranks of ``dedup_encounters`` need them
    df = (
        base.join(with_provider(epic, "epic", "_mrn"), spread_nulls(c("pri_mrn"), c("encounter_id")) == c("_mrn"), "left")
        .drop("_mrn")
        .join(with_provider(current, "payer_current", "member_id"), key, "left")
        .join(death, key, "left")
    )
    df = within_key(df, with_provider(effper, "payer_effper", "member_id"), key, "effper", "_effper")
    return schedule_flags(exclusion_flags(match_flags(df)), as_of).withColumns(
        {
            "effmonth": F.substring("effper", 6, 7),
            "pc_grouper_name": c("grouper_name"),
            "epic_dept": c("department_name"),
            "data_update_dt": as_date(as_of),
        }
    )


def patient_seen_mart(seen: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """One row per member, day, provider and completeness flag; its two ranks are 1, since only first rows are kept."""
    kept = dedup_encounters(mart_rows(seen, t, as_of)).withColumns({"dos_npi_rn": F.lit(1), "enc_rn": F.lit(1)})
    return kept.where(F.col("payer") != DROPPED_PAYER).select(*MART_COLS)
