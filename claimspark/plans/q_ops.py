"""Generic operator queries: dates, text, joins, aggregates, dedups, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions import codes, compat, dates
from claimspark.jobs import mapping as mapping_job
from claimspark.operators import aggregate, joins, project, ranking, upsert
from claimspark.plans.registry import query

c = F.col

# --------------------------------------------------------------------------- scalar functions


@query(
    "intnx_suite",
    """select claim_id, cast(date_trunc('month', d - interval 2 month) as date)::varchar as month_b,
         last_day(d - interval 2 month)::varchar as month_e, (d - cast(dayofweek(d) as int))::varchar as week_sun,
         cast(date_trunc('week', d) as date)::varchar as week_mon, (cast(date_trunc('week', d + 14) as date) + 6)::varchar as week_end
       from (select claim_id, date_of_service as d from {claim_header})""",
)
def intnx_suite(dom):
    d = c("date_of_service")
    return dom.claim_header.select(
        "claim_id",
        dates.intnx(d, "month", -2, "b").alias("month_b"),
        dates.intnx(d, "month", -2, "e").alias("month_e"),
        dates.intnx(d, "week", 0, "b").alias("week_sun"),
        dates.intnx(d, "week", 0, "b", "mon").alias("week_mon"),
        dates.intnx(d, "week", 2, "e", "mon").alias("week_end"),
    )


@query(
    "compat_dates",
    """select claim_id, strftime(d, '%Y-%m') as effper, strftime(d, '%m/%d/%Y') || ' - ' || strftime(p, '%m/%d/%Y') as label,
         year(d) as yr, (p - a)::int as los, (d + 180)::varchar as plus180, last_day(d)::varchar as month_last,
         cast(d + interval 1 month as date)::varchar as next_month, cast(date_trunc('month', d) as date)::varchar as month_first,
         try_strptime(nullif(t, '00000000'), '%Y%m%d')::date::varchar as parsed
       from (select claim_id, date_of_service as d, paid_date as p, admit_date as a,
               case when cast(claim_id as int) % 3 = 0 then '00000000' when cast(claim_id as int) % 5 = 0 then 'bad'
                 else strftime(paid_date, '%Y%m%d') end as t from {claim_header})""",
)
def compat_dates(dom):
    k = c("claim_id").cast("int")
    t = F.when(k % 3 == 0, "00000000").when(k % 5 == 0, "bad").otherwise(F.date_format("paid_date", "yyyyMMdd"))
    d, p = c("date_of_service"), c("paid_date")
    return dom.claim_header.select(
        "claim_id",
        dates.to_effper(d).alias("effper"),
        dates.period_label(d, p).alias("label"),
        F.year(d).alias("yr"),
        dates.los_days(p, c("admit_date")).alias("los"),
        F.date_add(d, 180).alias("plus180"),
        F.last_day(d).alias("month_last"),
        F.add_months(d, 1).alias("next_month"),
        dates.month_start(d).alias("month_first"),
        dates.parse_yyyymmdd(t).alias("parsed"),
    )


@query(
    "compat_strings",
    """select row_id, coalesce(identifier2, 'none') as nvl_id, case when identifier2 is null then 'null' when apptstatus = 'ARRIVED' then 'yes'
           else 'other' end as decoded, coalesce(identifier1, '') || '~' || coalesce(identifier2, '') as joined,
         substr(identifier2, instr(identifier2, '_') + 1) as after_sep, lpad(apptprovidernpi, 4, '0') as cut4,
         case when length(identifier1) <= 3 then lpad(identifier1, 3, '0') end as padded, upper(apptstatus) as up, substr(apptprovidernpi, 1, 3) as head,
         cast(trunc(try_cast(substr(identifier1, 2) || '.7' as decimal(38, 6))) as bigint)::varchar as int_id,
         try_cast(identifier2 as int) as as_int
       from {ryan_scheduling}""",
)
def compat_strings(dom):
    i1, i2 = c("identifier1"), c("identifier2")
    decoded = F.when(i2.isNull(), "null").otherwise(compat.decode(c("apptstatus"), "ARRIVED", "yes", "other"))
    return dom.ryan_scheduling.select(
        "row_id",
        compat.nvl(i2, "none").alias("nvl_id"),
        decoded.alias("decoded"),
        compat.oracle_concat(i1, F.lit("~"), i2).alias("joined"),
        compat.after_first(i2, "_").alias("after_sep"),
        compat.lpad_code(c("apptprovidernpi"), 4).alias("cut4"),
        compat.pad_if(i1, 3).alias("padded"),
        F.upper("apptstatus").alias("up"),
        F.substring("apptprovidernpi", 1, 3).alias("head"),
        compat.to_id(F.concat(F.substring(i1, 2, 20), F.lit(".7"))).alias("int_id"),
        compat.try_int(i2).alias("as_int"),
    )


@query(
    "decode_null_safe",
    """select paid_status, case when paid_status is null then 'none' when paid_status = '1' then 'paid' else 'open' end as label,
         nullif(drg_desc, 'DRG - X') as drg_desc, count(*) as n from {claim_header} group by 1, 2, 3""",
)
def decode_null_safe(dom):
    blanked = dom.claim_header.select("paid_status", F.when(c("drg_desc") == "DRG - X", "").otherwise(c("drg_desc")).alias("drg_desc"))
    cleaned = compat.empty_to_null(blanked)
    label = compat.decode(c("paid_status"), None, "none", "1", "paid", "open")
    return cleaned.groupBy("paid_status", label.alias("label"), "drg_desc").agg(F.count(F.lit(1)).alias("n"))


@query(
    "appt_reason",
    """select case when upper(reason_visit_name) in ('ANNUAL PHYSICAL', 'ANNUAL', 'ANNUAL / FOLLOW UP', 'MEDICARE ANNUAL WELLNESS VISIT')
           then 'ANNUAL/WELL VISIT' else reason_visit_name end as reason, count(*) as n
       from {visit_reason} left join {reason_name} on enc_reason_id = reason_visit_id group by 1""",
)
def appt_reason(dom):
    named = dom.visit_reason.join(dom.reason_name, c("enc_reason_id") == c("reason_visit_id"), "left")
    return named.groupBy(codes.appt_reason(c("reason_visit_name")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("stamp_load", "select ndc, medid, '2024-01-20' as load_date from {ndc_medid}")
def stamp_load(dom):
    return dates.stamp_load(dom.ndc_medid, "2024-01-20")


# --------------------------------------------------------------------------- joins
@query(
    "range_join_periods",
    """select p.measurement_period_desc, p.start_dt::varchar as start_dt, count(*) as n, count(distinct m.member_id) as members
       from {member_months} m join {meas_period} p on m.effper_dt between p.start_dt and p.end_dt group by 1, 2""",
)
def range_join_periods(dom):
    joined = joins.range_join(dom.member_months, dom.meas_period, "effper_dt")
    return joined.groupBy("measurement_period_desc", "start_dt").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("member_id").alias("members")
    )


@query(
    "range_join_salted",
    """select p.measurement_period_desc, p.start_dt::varchar as start_dt, count(*) as n
       from {claim_header} m join {meas_period} p on m.date_of_service between p.start_dt and p.end_dt group by 1, 2""",
)
def range_join_salted(dom):
    joined = joins.range_join(dom.claim_header, dom.meas_period, "date_of_service")
    return joined.groupBy("measurement_period_desc", "start_dt").agg(F.count(F.lit(1)).alias("n"))


@query(
    "with_rolling_period",
    """select measurement_period_desc, effyear, start_dt::varchar as start_dt, end_dt::varchar as end_dt from {meas_period}
       union all select 'Rolling 12', '2023', '2023-01-01', '2023-12-31'""",
)
def with_rolling_period(dom):
    return project.with_rolling_period(dom.meas_period, dates.as_date("2023-01-01"), dates.as_date("2023-12-31"))


@query(
    "rolling_range_agg",
    """select * from (with d as (select lob, cast(strftime(service_dt, '%Y%m') as int) as yrmo, allowed_amount, unit_count from {fact_service}),
         p as (select distinct yrmo as window_end, cast(strftime(strptime(yrmo::varchar, '%Y%m') - interval 11 month, '%Y%m') as int) as window_start from d)
       select window_start, window_end, lob, cast(sum(allowed_amount) as double) as allowed, cast(sum(unit_count) as double) as units
       from p join d on d.yrmo between window_start and window_end group by 1, 2, 3)""",
)
def rolling_range_agg(dom):
    yrmo = lambda d: F.date_format(d, "yyyyMM").cast("int")
    data = dom.fact_service.withColumn("yrmo", yrmo(c("service_dt")))
    months = dom.fact_service.select(F.trunc("service_dt", "MM").alias("m")).distinct()
    drivers = months.select(yrmo(F.add_months("m", -11)).alias("window_start"), yrmo(c("m")).alias("window_end"))
    return aggregate.rolling_range_agg(data, drivers, "yrmo", ["lob"], {"allowed": "allowed_amount", "units": "unit_count"})


@query(
    "null_tolerant_join",
    """select a.cpt_modifier1, a.cpt_modifier2, a.cap_claim_ind, a.n, b.members
       from (select cpt_modifier1, cpt_modifier2, cap_claim_ind, count(*) as n from {fact_service} group by 1, 2, 3) a
       left join (select cpt_modifier1, cpt_modifier2, cap_claim_ind, count(distinct member_id) as members from {fact_service} group by 1, 2, 3) b
         on a.cpt_modifier1 is not distinct from b.cpt_modifier1 and a.cpt_modifier2 is not distinct from b.cpt_modifier2
         and a.cap_claim_ind = b.cap_claim_ind""",
)
def null_tolerant_join(dom):
    key = ["cpt_modifier1", "cpt_modifier2", "cap_claim_ind"]
    left = dom.fact_service.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    right = dom.fact_service.groupBy(*key).agg(F.countDistinct("member_id").alias("members"))
    return joins.null_tolerant_join(left, right, {k: k for k in key}, never_on_null=["cap_claim_ind"])


@query(
    "semi_filter",
    """select claim_id, member_id, claim_place_of_service from {claim_header} where claim_place_of_service in
       (select claim_place_of_service from {place_list})""",
)
def semi_filter(dom):
    kept = joins.semi_filter(dom.claim_header, dom.place_list, {"claim_place_of_service": "claim_place_of_service"})
    return kept.select("claim_id", "member_id", "claim_place_of_service")


@query(
    "filter_in_table",
    """select lob, count(*) as n, cast(sum(paid_amount) as double) as paid from {fact_service}
       where service_code in (select proc_code from {excluded_list}) group by 1""",
)
def filter_in_table(dom):
    kept = joins.filter_in_table(dom.fact_service, "service_code", dom.excluded_list, "proc_code")
    return kept.groupBy("lob").agg(F.count(F.lit(1)).alias("n"), F.sum("paid_amount").alias("paid"))


@query(
    "flag_exists",
    """select claim_id, member_id, case when exists (select 1 from {fact_service} f where f.claim_id = h.claim_id and f.member_id = h.member_id
         and f.service_code in ('G0402', 'G0438', 'G0439')) then 'Y' else 'N' end as awv from {claim_header} h""",
)
def flag_exists(dom):
    wellness = dom.fact_service.where(c("service_code").isin(*codes.WELLNESS_SERVICES))
    flagged = joins.flag_exists(dom.claim_header, wellness, {"claim_id": "claim_id", "member_id": "member_id"}, "awv", "Y", "N")
    return flagged.select("claim_id", "member_id", "awv")


@query(
    "computed_key_join",
    """select e.pat_enc_csn_id, e.contact_date::varchar as contact_date, p.effper, p.n from {encounter} e left join
         (select strftime(date_of_service, '%Y-%m') as effper, count(*) as n from {claim_header} group by 1) p
         on strftime(e.contact_date, '%Y-%m') = p.effper""",
)
def computed_key_join(dom):
    months = dom.claim_header.groupBy(dates.to_effper(c("date_of_service")).alias("effper")).agg(F.count(F.lit(1)).alias("n"))
    joined = dom.encounter.withColumn("_key", dates.to_effper(c("contact_date"))).join(months, c("_key") == c("effper"), "left")
    return joined.select("pat_enc_csn_id", "contact_date", "effper", "n")


@query(
    "role_join",
    """select h.claim_id, s.full_name as servicing_full_name, s.lvl4_practice as servicing_lvl4_practice, a.full_name as attending_full_name,
         a.lvl4_practice as attending_lvl4_practice from {claim_header} h left join {provider} s on h.servicing_npi = s.npi
         left join {provider} a on h.attending_npi = a.npi""",
)
def role_join(dom):
    df = joins.join_role(dom.claim_header, dom.provider, c("servicing_npi"), "npi", "servicing", ["full_name", "lvl4_practice"])
    df = joins.join_role(df, dom.provider, c("attending_npi"), "npi", "attending", ["full_name", "lvl4_practice"])
    return df.select("claim_id", *[f"{r}_{n}" for r in ("servicing", "attending") for n in ("full_name", "lvl4_practice")])


# --------------------------------------------------------------------------- slices and rollups
def _slices():
    return {
        "Commercial": c("lob").isin("Commercial", "Medicare"),
        "Commercial FI": (c("lob") == "Commercial") & (c("include_flag") == "Y"),
        "Medicare": c("lob") == "Medicare",
        "MSSP": c("payer").like("MSSP%"),
        "All": F.lit(True),
    }


SLICE_SQL = " union all ".join(
    f"select '{name}' as slice, yrmo, count(distinct member_id) as util_mbrs, count(*) as n, cast(sum(paid_amount) as double) as paid from base where {cond} group by 2"
    for name, cond in {
        "Commercial": "lob in ('Commercial', 'Medicare')",
        "Commercial FI": "lob = 'Commercial' and include_flag = 'Y'",
        "Medicare": "lob = 'Medicare'",
        "MSSP": "payer like 'MSSP%'",
        "All": "true",
    }.items()
)


def _slice(dom, fn):
    base = dom.fact_service.withColumn("yrmo", dates.to_effper(c("service_dt")))
    aggs = [F.countDistinct("member_id").alias("util_mbrs"), F.count(F.lit(1)).alias("n"), F.sum("paid_amount").alias("paid")]
    return fn(base, _slices(), "slice", ["yrmo"], aggs)


SLICE_ORACLE = "select * from (with base as (select *, strftime(service_dt, '%Y-%m') as yrmo from {fact_service}) " + SLICE_SQL + ")"


@query("slice_agg", SLICE_ORACLE)
def slice_agg(dom):
    return _slice(dom, aggregate.slice_agg)


@query("slice_agg_union", SLICE_ORACLE)
def slice_agg_union(dom):
    return _slice(dom, aggregate.slice_agg_union)


USAGE = """select nullif(event_type, 'error') as step, user_id * 1000 as input_tokens, event_id % 900 as output_tokens,
      cast(value as decimal(18,2)) as response_time_seconds, event_id,
      cast(round(cast(user_id * 1000 as decimal(18,0)) * 1.25 / 1000000 + cast(event_id % 900 as decimal(18,0)) * 10 / 1000000, 6) as decimal(18,6)) as cost
    from {events}"""


def _usage(dom):
    return dom.events.select(
        F.nullif("event_type", F.lit("error")).alias("step"),
        (c("user_id") * 1000).alias("input_tokens"),
        (c("event_id") % 900).alias("output_tokens"),
        c("value").cast("decimal(18,2)").alias("response_time_seconds"),
        "event_id",
    )


@query(
    "usage_rollup",
    """select coalesce(step, 'unknown') as step, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(output_tokens) as bigint) as output_tokens,
         cast(sum(cost) as double) as cost_usd, cast(sum(response_time_seconds) as double) as response_time_seconds, count(*) as calls from {usage} group by 1
       union all select 'all_steps', cast(sum(input_tokens) as bigint), cast(sum(output_tokens) as bigint), cast(sum(cost) as double),
         cast(sum(response_time_seconds) as double), count(*) from {usage}""",
    usage=USAGE,
)
def usage_rollup(dom):
    return aggregate.usage_rollup(_usage(dom))


@query(
    "usage_rollup_last",
    """select coalesce(step, 'unknown') as step, cast(arg_max(input_tokens, event_id) as bigint) as input_tokens,
         cast(arg_max(output_tokens, event_id) as bigint) as output_tokens, cast(arg_max(cost, event_id) as double) as cost_usd,
         cast(arg_max(response_time_seconds, event_id) as double) as response_time_seconds, count(*) as calls from {usage} group by 1
       union all select 'all_steps', cast(sum(input_tokens) as bigint), cast(sum(output_tokens) as bigint), cast(sum(cost) as double),
         cast(sum(response_time_seconds) as double), count(*) from {usage}""",
    usage=USAGE,
)
def usage_rollup_last(dom):
    return aggregate.usage_rollup(_usage(dom), "last", ["event_id"])


# --------------------------------------------------------------------------- dedups and set operations
@query(
    "latest_by",
    """select payer, lob, member_id, effper, npi from (select *, row_number() over (partition by payer, lob, member_id
         order by effper desc nulls first, npi nulls last) as pick from {management_reporting}) where pick = 1""",
)
def latest_by(dom):
    out = ranking.latest_by(dom.management_reporting, ["payer", "lob", "member_id"], "effper", [c("npi").asc_nulls_last()])
    return out.select("payer", "lob", "member_id", "effper", "npi")


@query(
    "nodupkey",
    """select member, dx_code, service_date::varchar as service_date from (select *, row_number() over (partition by member
         order by service_date, dx_code nulls last) as pick from {med_claims}) where pick = 1""",
)
def nodupkey(dom):
    return ranking.nodupkey(dom.med_claims, ["member"], [c("service_date").asc_nulls_last(), c("dx_code").asc_nulls_last()])


@query("nodupkey_keys", "select distinct member, dx_code from {med_claims}")
def nodupkey_keys(dom):
    return ranking.nodupkey(dom.med_claims, ["member", "dx_code"])


@query(
    "keep_best",
    """select payer, lob, member_id, effper, member_months, attributed_pcp_npi from (
         select *, row_number() over (partition by payer, lob, member_id order by member_months desc nulls last, effper desc, attributed_pcp_npi nulls last) as p2
         from (select *, row_number() over (partition by payer, lob, member_id, effper order by member_months desc nulls last, attributed_pcp_npi nulls last) as p1
               from {member_months}) where p1 = 1) where p2 = 1""",
)
def keep_best(dom):
    npi = c("attributed_pcp_npi").asc_nulls_last()
    months = c("member_months").desc_nulls_last()
    key = ["payer", "lob", "member_id"]
    out = ranking.keep_best(dom.member_months, [([*key, "effper"], [months, npi]), (key, [months, c("effper").desc(), npi])])
    return out.select(*key, "effper", "member_months", "attributed_pcp_npi")


@query(
    "sequence_numbers",
    """select payer, lob, member_id, claim_id, row_number() over (partition by payer, lob order by member_id, claim_id) as seq from {claim_header}""",
)
def sequence_numbers(dom):
    df = dom.claim_header.select("payer", "lob", "member_id", "claim_id")
    return ranking.number_rows(df, ["payer", "lob"], [c("member_id").asc(), c("claim_id").asc()], "seq")


@query(
    "union_all_sources",
    """select 'access' as source, cast(pat_enc_csn_id as varchar) as visit_id, npi, cast(null as varchar) as prov_id from {patient_access}
       union all select 'sched', cast(pat_enc_csn_id as varchar), null, prov_id from {sched_appt}""",
)
def union_all_sources(dom):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "visit_id", "npi", "prov_id")])
    access = dom.patient_access.select(F.lit("access").alias("source"), c("pat_enc_csn_id").alias("visit_id"), "npi")
    sched = dom.sched_appt.select(F.lit("sched").alias("source"), c("pat_enc_csn_id").alias("visit_id"), "prov_id")
    return project.stack([access, sched], schema)


@query("select_schema", "select cast(claim_id as bigint) as claim_id, payer, cast(tcc_paid as double) as tcc_paid from {claim_header}")
def select_schema(dom):
    schema = T.StructType([T.StructField("claim_id", T.LongType()), T.StructField("payer", T.StringType()), T.StructField("tcc_paid", T.DoubleType())])
    return project.select_schema(dom.claim_header, schema)


@query("apply_mapping", "select member as mbr_id, ndc as ndc_code, fill_date::varchar as fill_dt, event_id from {rx_fills}")
def apply_mapping(dom):
    out, _ = mapping_job.apply_mapping(dom.rx_fills, {"MEMBER": "mbr_id", "ndc": "ndc_code", "fill_date": "fill_dt"})
    return out


# --------------------------------------------------------------------------- upsert
OLD = "select claim_id as path, drg_desc as content, drg as note from {claim_header} where cast(claim_id as int) % 3 <> 0"
NEW = """select claim_id as path, case when cast(claim_id as int) % 4 = 0 then '' when cast(claim_id as int) % 4 = 1 then null
           else 'new ' || bill_code_ub end as content, cast(null as varchar) as note from {claim_header} where cast(claim_id as int) % 2 = 0"""


def _old_new(dom):
    k = c("claim_id").cast("int")
    old = dom.claim_header.where(k % 3 != 0).select(c("claim_id").alias("path"), c("drg_desc").alias("content"), c("drg").alias("note"))
    text = F.when(k % 4 == 0, "").when(k % 4 == 1, None).otherwise(F.concat(F.lit("new "), "bill_code_ub"))
    new = dom.claim_header.where(k % 2 == 0).select(c("claim_id").alias("path"), text.alias("content"))
    return old, new


@query(
    "upsert_replace",
    """select coalesce(o.path, n.path) as path, if(n.path is not null, n.content, o.content) as content, o.note
       from {old} o full join {new} n on o.path = n.path""",
    old=OLD,
    new=NEW,
)
def upsert_replace(dom):
    old, new = _old_new(dom)
    return upsert.upsert(old, new, ["path"], {"content": "replace"})


@query(
    "upsert_prefer_nonempty",
    """select coalesce(o.path, n.path) as path, case when o.path is not null and (n.content is null or trim(n.content) = '') then o.content else n.content end as content, o.note
       from {old} o full join {new} n on o.path = n.path""",
    old=OLD,
    new=NEW,
)
def upsert_prefer_nonempty(dom):
    old, new = _old_new(dom)
    return upsert.upsert(old, new, ["path"], {"content": "prefer_nonempty"})


@query(
    "upsert_known_only",
    """select o.path, if(n.path is not null, n.content, o.content) as content, o.note from {old} o left join {new} n on o.path = n.path""",
    old=OLD,
    new=NEW,
)
def upsert_known_only(dom):
    old, new = _old_new(dom)
    return upsert.upsert(old, new, ["path"], {"content": "replace"}, insert_unmatched=False)


@query(
    "upsert_append_distinct",
    """select coalesce(o.k, n.k) as k, array_to_string(coalesce(o.items, []) || list_filter(coalesce(n.items, []), lambda x, i: not list_contains(coalesce(o.items, []), x) and list_position(n.items, x) = i), ',') as items
       from (select claim_id as k, [drg_desc, claim_type] as items from {claim_header} where cast(claim_id as int) % 3 <> 0) o
       full join (select claim_id as k, [claim_type, claim_category] as items from {claim_header} where cast(claim_id as int) % 2 = 0) n on o.k = n.k""",
)
def upsert_append_distinct(dom):
    k = c("claim_id").cast("int")
    old = dom.claim_header.where(k % 3 != 0).select(c("claim_id").alias("k"), F.array("drg_desc", "claim_type").alias("items"))
    new = dom.claim_header.where(k % 2 == 0).select(c("claim_id").alias("k"), F.array("claim_type", "claim_category").alias("items"))
    merged = upsert.upsert(old, new, ["k"], {"items": "append_distinct"})
    return merged.select("k", F.array_join("items", ",").alias("items"))
