"""Unified visits, patient-seen and member reporting queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from claimspark.functions.dates import as_date
from claimspark.jobs import patient_seen, unified_member, visits
from claimspark.jobs.publish import publish_copy
from claimspark.operators.project import id_bridge
from claimspark.plans.registry import query
from claimspark.session import stored

AS_OF = "2024-01-20"
AS_OF_DATE = dt.date(2024, 1, 20)

# --------------------------------------------------------------------------- checking SQL, in layers
MM = """select * from (select *, row_number() over (partition by payer, lob, member_id, effper_dt order by member_months desc nulls last,
          attributed_pcp_npi nulls last, attributed_pcp_tax_id nulls last) as pick from {member_months}) where pick = 1"""
EXT = """select a.*, coalesce(x.member_id_token, a.member_id) as mem_id_ref
         from {active_members} a left join {id_xwalk} x on a.member_id = x.member_id"""
REASON = """select v.pat_enc_csn_id, case when upper(n.reason_visit_name) in ('ANNUAL PHYSICAL', 'ANNUAL', 'ANNUAL / FOLLOW UP',
            'MEDICARE ANNUAL WELLNESS VISIT') then 'ANNUAL/WELL VISIT' else n.reason_visit_name end as reason
            from {visit_reason} v left join {reason_name} n on v.enc_reason_id = n.reason_visit_id"""
APPTS = """
    select p.mrn, cast(p.appt_dttm as date) as appt_dt, cast(p.pat_enc_csn_id as varchar) as visit_id,
      upper(p.appt_status_name) as status, p.npi, r.reason, 'MV_DM_PATIENT_ACCESS' as source
    from {patient_access} p left join {reason} r on p.pat_enc_csn_id = r.pat_enc_csn_id where p.appt_dttm >= date '2018-01-01'
    union all
    select b.y_mrn, cast(a.appt_dttm as date), cast(a.pat_enc_csn_id as varchar), upper(d.name), c.npi, r.reason, 'F_SCHED_APPT'
    from {sched_appt} a left join (select distinct y_mrn, pat_id from {patient}) b on a.pat_id = b.pat_id
    left join (select distinct prov_id, npi from {provider_id}) c on a.prov_id = c.prov_id
    left join {appt_status} d on a.appt_status_c = d.appt_status_c
    left join {reason} r on a.pat_enc_csn_id = r.pat_enc_csn_id where a.appt_dttm >= date '2018-01-01'"""
BRIDGE = """
    select payer, lob, member_id, fact from {fact_member} where WHICH and payer <> 'ANY' and fact <> '0'
    union select payer, lob, member_id, pri_mrn from {claim_header} where date_of_service >= date '2018-01-01' and pri_mrn is not null"""
BRIDGE_MRN = BRIDGE.replace("WHICH", "fact_shortdescr = 'PRI-MRN'")
BRIDGE_ID = BRIDGE.replace("WHICH", "fact_category = 'Member Identifiers'")
B_CLAIMS = """
    select h.payer, h.lob, h.member_id, h.pri_mrn as mrn, h.claim_id as encounter_id, h.effper, h.date_of_service,
      'CLAIMSTAR' as source, 'ARRIVED' as visit_status_type, if(sw, attending_npi, servicing_npi) as servicing_pcp_npi,
      if(sw, attending_tin, servicing_tin) as servicing_pcp_tin, if(w.claim_id is null, 'N', 'Y') as awv_indicator, 1 as everyone
    from (select *, coalesce((servicing_npi in ('1013360528', '1851328199', '1124347182', '1588691828', '1730317769', '1215978960')
             or claim_place_of_service = 'Hospital') and claim_type = 'Facility', false) as sw from {claim_header}) h
    left join (select distinct payer, lob, member_id, claim_id from {fact_service} where include_flag = 'Y'
               and service_code in ('G0402', 'G0438', 'G0439')) w
      on h.payer = w.payer and h.lob = w.lob and h.member_id = w.member_id and h.claim_id = w.claim_id
    where include_flag = 'Y' and claim_type in ('Professional', 'Facility') and claim_category in ('Professional', 'Outpatient')
      and claim_place_of_service in ('Office Visit - PCP Visit', 'Hospital', 'Office Visit - Specialty Consult', 'Clinic')
      and ip_episode_key is null and ed_episode_key is null and date_of_service >= date '2018-01-01'"""
B_APPT = """
    select b.payer, b.lob, b.member_id, a.mrn, a.visit_id as encounter_id, strftime(a.appt_dt, '%Y-%m') as effper,
      a.appt_dt as date_of_service, a.source, a.status as visit_status_type, a.npi as servicing_pcp_npi,
      cast(null as varchar) as servicing_pcp_tin, if(a.reason = 'ANNUAL/WELL VISIT', 'Y', 'N') as awv_indicator, 0 as everyone
    from {appts} a left join {bridge_mrn} b on a.mrn = b.fact"""
B_RYAN = """
    select b.payer, b.lob, coalesce(b.member_id, r.raw_id) as member_id, m.pri_mrn as mrn,
      coalesce(identifier1, '') || '~' || coalesce(identifier2, '') || '~' || strftime(r.appt_dt, '%Y-%m-%d') as encounter_id,
      strftime(r.appt_dt, '%Y-%m') as effper, r.appt_dt as date_of_service, 'RYAN SCHEDULING' as source,
      r.apptstatus as visit_status_type, r.apptprovidernpi as servicing_pcp_npi, cast(null as varchar) as servicing_pcp_tin,
      cast(null as varchar) as awv_indicator, 0 as everyone
    from (select *, cast(apptdate as date) as appt_dt, substr(identifier2, instr(identifier2, '_') + 1) as raw_id,
            row_number() over (partition by identifier1, identifier2, cast(apptdate as date)
              order by load_date desc nulls last, apptdate, apptstatus, apptprovidernpi, row_id) as pick from {ryan_scheduling}) r
    left join {bridge_id} b on r.raw_id = b.fact
    left join {member} m on b.payer = m.payer and b.lob = m.lob and b.member_id = m.member_id
    where r.pick = 1 and r.appt_dt >= date '2018-01-01'"""


def _visit_select(base: str, distinct: str) -> str:
    def role(p, name, pod, practice):
        return f"""{p}.lvl2_emp_status as {name}_pcp_emp_status, {pod} as {name}_pcp_pod, {practice} as {name}_pcp_practice,
          {p}.full_name as {name}_pcp_provider, {p}.pcp_spc as {name}_prov_pcp_spc, {p}.cms_pcp_spc as {name}_prov_cms_pcp_spc"""

    def epic(npi, status, name):
        return f"case when {npi} is not null and {status}.epic_status is null then 'NON-EPIC' else {status}.epic_status end as {name}_prac_epic_status"

    yn = "case when {} then 'Y' else 'N' end as {}"
    cur = "case when ext.currently_active = 'Y' then ext.attributed_pcp_npi end"
    prov = "(select distinct npi, lvl2_emp_status, lvl3_subgroup, lvl4_practice, full_name, default_tin, pcp_spc, cms_pcp_spc from {provider})"
    return f"""
      select {distinct} v.payer, v.lob, v.member_id, v.mrn, v.encounter_id, v.effper, v.date_of_service, v.source, v.visit_status_type,
        mm.attributed_pcp_npi as historical_pcp_npi, mm.attributed_pcp_tax_id as historical_pcp_tin,
        {role('hp', 'historical', 'hp.lvl3_subgroup', 'hp.lvl4_practice')}, {epic('mm.attributed_pcp_npi', 'he', 'historical')},
        {cur} as current_pcp_npi, mme.attributed_pcp_tax_id as current_pcp_tin,
        {role('cp', 'current', 'ext.pcp_lvl3_pod', 'ext.pcp_lvl4_practice')}, {epic('ext.attributed_pcp_npi', 'ce', 'current')},
        v.servicing_pcp_npi, v.servicing_pcp_tin, {role('sp', 'servicing', 'sp.lvl3_subgroup', 'sp.lvl4_practice')},
        {epic('v.servicing_pcp_npi', 'se', 'servicing')},
        {yn.format('mm.member_months > 0', 'attributed_at_visit')}, coalesce(ext.currently_active, 'N') as currently_attributed,
        {yn.format('mm.attributed_pcp_npi = v.servicing_pcp_npi', 'hist_serv_prov_check')},
        {yn.format('hp.lvl4_practice = sp.lvl4_practice', 'hist_serv_prac_check')},
        {yn.format(cur + ' = v.servicing_pcp_npi', 'current_serv_prov_check')},
        {yn.format('cp.lvl4_practice = sp.lvl4_practice', 'current_serv_prac_check')},
        {yn.format("sp.pcp_spc = 'PCP'", 'visit_with_any_spc_pcp')}, {yn.format("sp.cms_pcp_spc = 'PCP'", 'visit_with_any_cms_spc_pcp')},
        v.awv_indicator, date '{AS_OF}' as load_dt
      from {{{base}}} v
      left join {{mm}} mm on v.payer = mm.payer and v.lob = mm.lob and v.member_id = mm.member_id and v.effper = mm.effper
      left join {prov} hp on mm.attributed_pcp_npi = hp.npi
      left join {{practice_status}} he on hp.lvl4_practice = he.lvl4_practice
      left join {{ext}} ext on v.payer = ext.payer and v.lob = ext.lob and v.member_id = ext.mem_id_ref
        and (v.everyone = 1 or ext.currently_active = 'Y')
      left join {prov} cp on ext.attributed_pcp_npi = cp.npi
      left join {{practice_status}} ce on ext.pcp_lvl4_practice = ce.lvl4_practice
      left join {{mm}} mme on ext.payer = mme.payer and ext.lob = mme.lob and ext.mem_id_ref = mme.member_id
        and ext.latest_active_month = mme.effper
      left join {prov} sp on v.servicing_pcp_npi = sp.npi
      left join {{practice_status}} se on sp.lvl4_practice = se.lvl4_practice"""


VISITS = " union all ".join(
    f"(select * from ({_visit_select(b, d)}))" for b, d in (("b_claims", ""), ("b_appt", "distinct"), ("b_ryan", "distinct"))
)
L_VISITS = {
    "mm": MM, "ext": EXT, "reason": REASON, "appts": APPTS, "bridge_mrn": BRIDGE_MRN, "bridge_id": BRIDGE_ID, "b_claims": B_CLAIMS,
    "b_appt": B_APPT, "b_ryan": B_RYAN, "visits": VISITS,
}
DATES = "replace (cast(date_of_service as varchar) as date_of_service, cast(load_dt as varchar) as load_dt)"


def _visits(dom):
    return visits.unified_visits(_tables(dom), AS_OF)


class _tables(dict):
    """Domain tables looked up by name on demand."""

    def __init__(self, dom):
        super().__init__()
        self.dom = dom

    def __missing__(self, name):
        return self.dom.table(name)


@query("unified_visits", f"select * {DATES} from {{visits}}", **L_VISITS)
def unified_visits(dom):
    return _visits(dom)


@query("member_months", "select * exclude (pick) replace (cast(effper_dt as varchar) as effper_dt) from {mm}", mm=MM)
def member_months(dom):
    return visits.member_months(dom.member_months)


@query(
    "appointments",
    "select * replace (cast(appt_dt as varchar) as appt_dt) from {appts}",
    reason=REASON,
    appts=APPTS,
)
def appointments(dom):
    return visits.appointments(_tables(dom))


@query("member_id_crosswalk", "select * from {ext}", ext=EXT)
def member_id_crosswalk(dom):
    return visits.active_members(dom.active_members, dom.id_xwalk).drop("member_id_token")


@query("identifier_bridge", "select * from {bridge_mrn}", bridge_mrn=BRIDGE_MRN)
def identifier_bridge(dom):
    return visits.identifier_bridge(dom.fact_member, dom.claim_header, F.col("fact_shortdescr") == "PRI-MRN")


@query(
    "bridge_members",
    """select a.visit_id, a.source, a.mrn, b.payer, b.lob, b.member_id from {appts} a left join {bridge_mrn} b on a.mrn = b.fact""",
    reason=REASON,
    appts=APPTS,
    bridge_mrn=BRIDGE_MRN,
)
def bridge_members(dom):
    out = visits.appointment_visits(_tables(dom))
    return out.select(F.col("encounter_id").alias("visit_id"), "source", "mrn", "payer", "lob", "member_id")


@query(
    "servicing_provider",
    "select payer, lob, member_id, encounter_id, servicing_pcp_npi, servicing_pcp_tin, awv_indicator from {b_claims}",
    b_claims=B_CLAIMS,
)
def servicing_provider(dom):
    out = visits.claim_visits(dom.claim_header, dom.fact_service)
    return out.select("payer", "lob", "member_id", "encounter_id", "servicing_pcp_npi", "servicing_pcp_tin", "awv_indicator")


@query(
    "ryan_visits",
    "select * exclude (everyone) replace (cast(date_of_service as varchar) as date_of_service) from {b_ryan}",
    bridge_id=BRIDGE_ID,
    b_ryan=B_RYAN,
)
def ryan_visits(dom):
    return visits.ryan_visits(_tables(dom))


@query(
    "legacy_visits",
    f"select * {DATES} from {{visits}} where visit_status_type in ('ARRIVED', 'SCHEDULED', 'COMPLETED')",
    **L_VISITS,
)
def legacy_visits(dom):
    return visits.legacy_visits(_visits(dom))


@query(
    "publish_copy",
    f"select * {DATES} from {{visits}}",
    **L_VISITS,
)
def publish_copy_query(dom):
    return publish_copy(_visits(dom), visits.VISIT_COLS)


@query(
    "member_filters",
    """select member_id, count(*) as claims from {claim_header} where member_id is not null and instr(member_id, '?') = 0
       and not regexp_matches(member_id, '(?i)subscriber') and not (member_id ^@ '00000000' and length(member_id) >= 16
       and right(member_id, 8) = '00000000') group by 1""",
)
def member_filters(dom):
    from claimspark.functions.codes import valid_member

    return dom.claim_header.where(valid_member(F.col("member_id"))).groupBy("member_id").agg(F.count(F.lit(1)).alias("claims"))


@query(
    "visit_standardize",
    """select if(instr(payer, 'MSSP') > 0, 'MSSP NYMP', payer) as payer, payer as payer_not_chgd, status as visit_status_type, count(*) as n
       from (select payer, case visit_status_type when 'CANCELLED' then 'CANCELED' when 'NOSHOW' then 'NO SHOW' else visit_status_type end as status
             from {visits}) group by 1, 2, 3""",
    **L_VISITS,
)
def visit_standardize(dom):
    out = patient_seen.standardize_visit(_visits(dom).select("payer", "visit_status_type"))
    return out.groupBy("payer", "payer_not_chgd", "visit_status_type").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- patient seen
LINKABLE = """
    select * replace (if(instr(payer, 'MSSP') > 0, 'MSSP NYMP', payer) as payer,
      case visit_status_type when 'CANCELLED' then 'CANCELED' when 'NOSHOW' then 'NO SHOW' else visit_status_type end as visit_status_type),
      payer as payer_not_chgd, substr(effper, 1, 4) as effyear
    from {visits} where date_of_service >= date '2019-01-01' and payer is not null and lob is not null and servicing_pcp_npi is not null
      and member_id not like '%?%' and upper(member_id) not like '%SUBSCRIBER%' and member_id not like '00000000%00000000'"""
ENC = """
    select cast(e.pat_enc_csn_id as varchar) as enc_id, pc.grouper_name, d.department_name, e.enc_type_c, z.name as enc_type_pos,
      p.proc_code, p.proc_name as proc_code_desc, s.prov_name, t.title as prov_title, t.service_type_c as prov_title_id,
      a.name as appt_status, e.enc_closed_yn,
      if(a.title = 'COMPLETED' or e.enc_closed_yn = 'Y', 1, 0) as c1, if(l.proc_id is not null and not (e.enc_type_c = '50'), 1, 0) as c2,
      if(k.provider_type_c is not null, 1, 0) as c3, if(pc.grouper_name is not null, 1, 0) as c4
    from {encounter} e left join {department} d on e.department_id = d.department_id
    left join {procedure} p on e.los_prime_proc_id = p.proc_id left join {enc_type} z on e.enc_type_c = z.disp_enc_type_c
    left join {ser_provider} s on e.visit_prov_id = s.prov_id left join {ser_title} t on s.provider_type_c = t.service_type_c
    left join {appt_status} a on e.appt_status_c = a.appt_status_c left join {los_list} l on e.los_prime_proc_id = l.proc_id
    left join {provider_type_list} k on t.service_type_c = k.provider_type_c
    left join {dept_grouper} pc on e.department_id = pc.grouper_records_numeric_id where e.contact_date >= date '2019-01-01'"""
XFS = """
    select payer, lob, member_id, claim_id, service_code, excl_code, descr from (
      select f.*, e.proc_code as excl_code, coalesce(e.proc_code_description, i.proc_name) as descr,
        row_number() over (partition by payer, lob, member_id, claim_id, service_dt
          order by e.proc_code nulls last, i.proc_code desc nulls last, service_code nulls last) as pick
      from {fact_service} f left join {excluded_list} e on f.service_code = e.proc_code
      left join {los_list} i on f.service_code = i.proc_code where f.service_dt >= date '2019-01-01') where pick = 1"""
SEEN = f"""
    select v.*, x.* exclude (enc_id, c1, c2, c3, c4), c1 as pc_visit_cmplt_close_yn, c2 as pc_visit_los_code_yn, c3 as pc_visit_prov_type_yn,
      c4 as pc_visit_grouper_yn, coalesce(c1 * c2 * c3 * c4, 0) as pc_visit_all_match_yn, date '{AS_OF}' as create_dt
    from {{linkable}} v left join {{enc}} x on v.encounter_id = x.enc_id where v.source = 'MV_DM_PATIENT_ACCESS'
    union all by name
    select *, date '{AS_OF}' as create_dt from {{linkable}} where source = 'RYAN SCHEDULING' and visit_status_type in ('SCHEDULED', 'ARRIVED')
    union all by name
    select v.*, h.claim_place_of_service as enc_type_pos, h.service_code as proc_code, h.descr as proc_code_desc, 'Completed' as appt_status,
      'Y' as enc_closed_yn, 1 as pc_visit_cmplt_close_yn, if(h.excl_code is null, 1, 0) as pc_visit_los_code_yn,
      if(h.excl_code is null, 1, 0) as pc_visit_all_match_yn, date '{AS_OF}' as create_dt
    from {{linkable}} v left join (
      select h.*, x.service_code, x.excl_code, x.descr from {{claim_header}} h join {{place_list}} using (claim_place_of_service)
      left join {{xfs}} x on h.payer = x.payer and h.lob = x.lob and h.member_id = x.member_id and h.claim_id = x.claim_id
      where h.include_flag = 'Y' and h.claim_type in ('Professional', 'Facility') and h.claim_category in ('Professional', 'Outpatient')) h
      on v.encounter_id = h.claim_id and v.member_id = h.member_id and v.payer_not_chgd = h.payer and v.lob = h.lob
    where v.source = 'CLAIMSTAR'"""
L_SEEN = {**L_VISITS, "linkable": LINKABLE, "enc": ENC, "xfs": XFS, "seen": SEEN}
SEEN_DATES = DATES[:-1] + ", cast(create_dt as varchar) as create_dt)"


def _seen(dom):
    return patient_seen.patient_seen_all(_visits(dom), _tables(dom), AS_OF)


@query("patient_seen_all", f"select * {SEEN_DATES} from {{seen}}", **L_SEEN)
def patient_seen_all(dom):
    return _seen(dom)


@query(
    "encounter_checks",
    """select c1 as pc_visit_cmplt_close_yn, c2 as pc_visit_los_code_yn, c3 as pc_visit_prov_type_yn, c4 as pc_visit_grouper_yn,
         c1 * c2 * c3 * c4 as pc_visit_all_match_yn, count(*) as n from {enc} group by all""",
    enc=ENC,
)
def encounter_checks(dom):
    names = patient_seen.CHECK_COLS
    return patient_seen.encounter_detail(_tables(dom)).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def _match(side: str) -> str:
    return f"""if(((upper({side}_lvl4_practice) = upper(servicing_pcp_practice) and {side}_pod not like '%Requires Investigation%')
        or {side}_npi = servicing_pcp_npi) and los = 1 and done = 1
        and ((source = 'MV_DM_PATIENT_ACCESS' and kind = 1) or source = 'CLAIMSTAR'), 1, 0) as {side}_match"""


MART_ROWS = f"""
    with joined as (
      select s.* exclude (mrn, load_dt, create_dt), s.mrn as pri_mrn, mr.prac_emp_status, mr.pcp_emp_status, mr.crnt_pyr, mr.vbc_flag, m.death_dt,
        mr.npi as payer_effper_npi, pe.lvl4_practice as payer_effper_lvl4_practice, pe.full_name as payer_effper_full_name,
        pe.lvl3_subgroup as payer_effper_pod, pe.lvl5_prac_emp_status as payer_effper_prac_emp_status,
        cur.npi as payer_current_npi, pc.lvl4_practice as payer_current_lvl4_practice, pc.full_name as payer_current_full_name,
        pc.lvl3_subgroup as payer_current_pod, pc.lvl5_prac_emp_status as payer_current_prac_emp_status,
        ep.npi as epic_npi, pp.lvl4_practice as epic_lvl4_practice, pp.full_name as epic_full_name, pp.lvl3_subgroup as epic_pod,
        pp.lvl5_prac_emp_status as epic_prac_emp_status,
        s.pc_visit_los_code_yn as los, s.pc_visit_cmplt_close_yn as done, s.pc_visit_prov_type_yn as kind
      from {{seen}} s
      left join {{management_reporting}} mr on s.member_id = mr.member_id and s.lob = mr.lob and s.payer = mr.payer and s.effper = mr.effper
        and mr.effyear >= 2019
      left join (select * from {{management_reporting}} qualify row_number() over (partition by payer, lob, member_id
          order by effper desc nulls first, npi nulls last, prac_emp_status nulls last) = 1) cur
        on s.member_id = cur.member_id and s.lob = cur.lob and s.payer = cur.payer
      left join {{member}} m on s.member_id = m.member_id and s.lob = m.lob and s.payer = m.payer
      left join {{epic_pcp}} ep on s.mrn = ep.mrn
      left join {{provider}} pe on mr.npi = pe.npi left join {{provider}} pc on cur.npi = pc.npi left join {{provider}} pp on ep.npi = pp.npi
      where s.lob in ('Medicare', 'MA', 'Commercial', 'Medicaid') and s.effyear >= '2019'),
    flagged as (
      select *, {_match('payer_current')}, {_match('payer_effper')}, {_match('epic')},
        if(source = 'MV_DM_PATIENT_ACCESS' and los = 1 and done = 1 and kind = 1 and pc_visit_grouper_yn = 1, 1, 0) as pc_grouper_match,
        if(servicing_pcp_pod = '23 - Ryan Health' and los = 1 and done = 1 and source = 'CLAIMSTAR'
          and list_contains([epic_pod, payer_effper_pod, payer_current_pod], servicing_pcp_pod), 1, 0) as ryan_match,
        if(servicing_pcp_pod = '07 - One Medical' and los = 1 and done = 1
          and ((source = 'MV_DM_PATIENT_ACCESS' and kind = 1) or source = 'CLAIMSTAR')
          and list_contains([epic_pod, payer_effper_pod, payer_current_pod], servicing_pcp_pod), 1, 0) as one_med_match,
        if(servicing_prov_pcp_spc = 'PCP' and vbc_flag = 'Y', 1, 0) as historic_def_match,
        case when (source = 'MV_DM_PATIENT_ACCESS' and kind is null) or kind = 0 then 1 end as excluded_epic_prov_type,
        case when coalesce(los, 0) = 0 then 1 end as excluded_proc_code,
        case when coalesce(pc_visit_grouper_yn, 0) = 0 then 1 end as excluded_pc_grouper,
        case when coalesce(done, 1) = 1 then 1 end as excluded_vis_compl_clsd,
        case when coalesce(pc_visit_all_match_yn, 0) = 0 then 1 end as excluded_any_reason,
        if(los = 1 and done = 1 and ((source = 'MV_DM_PATIENT_ACCESS' and kind = 1) or source = 'CLAIMSTAR'), 1, 0) as completed_visit_yn,
        source = 'RYAN SCHEDULING' and visit_status_type in ('ARRIVED', 'SCHEDULED') as is_ryan,
        coalesce(source = 'MV_DM_PATIENT_ACCESS' and enc_type_c = '50' and visit_status_type = 'SCHEDULED' and grouper_name is not null, false) as is_epic
      from joined)
    select *, greatest(payer_current_match, payer_effper_match, epic_match, pc_grouper_match, ryan_match, one_med_match) as any_match,
      if((is_ryan and date_of_service > date '{AS_OF}') or is_epic, 1, 0) as scheduled_visit_yn,
      if((is_ryan or is_epic) and date_of_service > date '{AS_OF}', 1, 0) as sched_visit_future_yn,
      if((is_ryan or is_epic) and date_of_service > date '{AS_OF}' and date_of_service <= date '{AS_OF}' + 180, 1, 0) as scheduled_wi_180days_yn,
      substr(effper, 6, 7) as effmonth, grouper_name as pc_grouper_name, department_name as epic_dept, date '{AS_OF}' as data_update_dt
    from flagged"""
MART_NAMES = """
    payer, lob, member_id, pri_mrn, encounter_id, effper, date_of_service, source, visit_status_type, servicing_pcp_npi,
    servicing_pcp_tin, servicing_pcp_emp_status, servicing_pcp_pod, servicing_pcp_practice, servicing_pcp_provider,
    effmonth, effyear, prac_emp_status, pcp_emp_status, crnt_pyr, vbc_flag, death_dt, payer_effper_npi,
    payer_effper_lvl4_practice, payer_effper_full_name, payer_effper_pod, payer_effper_prac_emp_status,
    payer_current_npi, payer_current_lvl4_practice, payer_current_full_name, payer_current_pod,
    payer_current_prac_emp_status, epic_npi, epic_lvl4_practice, epic_full_name, epic_pod, epic_prac_emp_status,
    enc_closed_yn, pc_grouper_name, epic_dept, enc_type_c, enc_type_pos, proc_code, proc_code_desc, prov_title,
    prov_title_id, excluded_epic_prov_type, scheduled_visit_yn, sched_visit_future_yn, scheduled_wi_180days_yn,
    pc_visit_cmplt_close_yn, pc_visit_los_code_yn, pc_visit_prov_type_yn, pc_visit_grouper_yn, pc_visit_all_match_yn,
    payer_current_match, payer_effper_match, epic_match, pc_grouper_match, ryan_match, one_med_match, any_match,
    historic_def_match, servicing_prov_pcp_spc, servicing_prov_cms_pcp_spc, servicing_prac_epic_status,
    historical_pcp_npi, historical_pcp_tin, historical_pcp_emp_status, historical_pcp_pod, historical_pcp_practice,
    historical_pcp_provider, historical_prov_pcp_spc, historical_prov_cms_pcp_spc, historical_prac_epic_status,
    current_pcp_npi, current_pcp_tin, current_pcp_emp_status, current_pcp_pod, current_pcp_practice,
    current_pcp_provider, current_prov_pcp_spc, current_prov_cms_pcp_spc, current_prac_epic_status, attributed_at_visit,
    currently_attributed, hist_serv_prov_check, hist_serv_prac_check, current_serv_prov_check, current_serv_prac_check,
    visit_with_any_spc_pcp, visit_with_any_cms_spc_pcp, awv_indicator, data_update_dt"""
COPY_NAMES = """
    payer, lob, member_id, pri_mrn, encounter_id, effper, date_of_service, source, visit_status_type, servicing_pcp_npi,
    servicing_pcp_tin, servicing_pcp_emp_status, servicing_pcp_pod, servicing_pcp_practice, servicing_pcp_provider,
    effmonth, effyear, pc_grouper_name, epic_dept, enc_type_c, enc_type_pos, proc_code, proc_code_desc, prov_title,
    prov_title_id, prac_emp_status, pcp_emp_status, crnt_pyr, vbc_flag, death_dt, payer_effper_npi,
    payer_effper_lvl4_practice, payer_effper_full_name, payer_effper_pod, payer_effper_prac_emp_status,
    payer_current_npi, payer_current_lvl4_practice, payer_current_full_name, payer_current_pod,
    payer_current_prac_emp_status, epic_npi, epic_lvl4_practice, epic_full_name, epic_pod, epic_prac_emp_status,
    excluded_epic_prov_type, cast(null as int) as excluded_epic_enc_type, cast(null as int) as excluded_proc_code,
    cast(null as int) as excluded_any_reason, cast(null as int) as completed_visit_yn, scheduled_visit_yn,
    sched_visit_future_yn, scheduled_wi_180days_yn, payer_current_match, payer_effper_match, epic_match,
    pc_grouper_match, ryan_match, one_med_match, any_match, historic_def_match, servicing_prov_pcp_spc,
    servicing_prov_cms_pcp_spc, servicing_prac_epic_status, historical_pcp_npi, historical_pcp_tin,
    historical_pcp_emp_status, historical_pcp_pod, historical_pcp_practice, historical_pcp_provider,
    historical_prov_pcp_spc, historical_prov_cms_pcp_spc, historical_prac_epic_status, current_pcp_npi, current_pcp_tin,
    current_pcp_emp_status, current_pcp_pod, current_pcp_practice, current_pcp_provider, current_prov_pcp_spc,
    current_prov_cms_pcp_spc, current_prac_epic_status, attributed_at_visit, currently_attributed, hist_serv_prov_check,
    hist_serv_prac_check, current_serv_prov_check, current_serv_prac_check, visit_with_any_spc_pcp,
    visit_with_any_cms_spc_pcp, awv_indicator, cast(null as varchar) as s0_encounter_table, cast(null as varchar) as
    s0_encounter_table_update, cast(null as varchar) as s1_encounter_table, cast(null as varchar) as
    s1_encounter_table_update, cast(null as int) as orig_rn, data_update_dt, enc_closed_yn, pc_visit_all_match_yn,
    pc_visit_cmplt_close_yn, pc_visit_grouper_yn, pc_visit_los_code_yn, pc_visit_prov_type_yn, dos_npi_rn, enc_rn"""
TIES = "proc_code nulls last, proc_code_desc nulls last, enc_type_pos nulls last, visit_status_type nulls last, pri_mrn nulls last"
MART = f"""
    select {MART_NAMES}, pick1 as dos_npi_rn, pick2 as enc_rn from (
      select *, row_number() over (partition by member_id, lob, payer, date_of_service, servicing_pcp_npi, pc_visit_cmplt_close_yn
        order by pc_visit_all_match_yn desc nulls last, source desc nulls first, encounter_id nulls last, {TIES}) as pick2
      from (select *, row_number() over (partition by member_id, lob, payer, date_of_service, servicing_pcp_npi, encounter_id
              order by any_match desc nulls first, pc_visit_all_match_yn desc nulls first, awv_indicator desc nulls first,
                source desc nulls first, {TIES}) as pick1 from {{mart_rows}}) where pick1 = 1)
    where pick2 = 1 and payer <> 'EMBLEM'"""
L_MART = {**L_SEEN, "mart_rows": MART_ROWS, "mart": MART}


@query(
    "patient_seen_mart",
    """select * replace (cast(date_of_service as varchar) as date_of_service, cast(death_dt as varchar) as death_dt,
       cast(data_update_dt as varchar) as data_update_dt) from {mart}""",
    **L_MART,
)
def patient_seen_mart(dom):
    return patient_seen.patient_seen_mart(_seen(dom), _tables(dom), AS_OF)


@query(
    "publish_mart_copy",
    f"""select * replace (cast(date_of_service as varchar) as date_of_service, cast(death_dt as varchar) as death_dt,
       cast(data_update_dt as varchar) as data_update_dt) from (select {COPY_NAMES} from {{mart}})""",
    **L_MART,
)
def publish_mart_copy(dom):
    mart = patient_seen.patient_seen_mart(_seen(dom), _tables(dom), AS_OF)
    return publish_copy(mart, patient_seen.COPY_COLS, patient_seen.COPY_ONLY)


FLAG_COLS = (
    "source payer_current_match payer_effper_match epic_match pc_grouper_match ryan_match one_med_match historic_def_match any_match"
    " excluded_epic_prov_type excluded_proc_code excluded_pc_grouper excluded_vis_compl_clsd excluded_any_reason completed_visit_yn"
    " scheduled_visit_yn sched_visit_future_yn scheduled_wi_180days_yn"
).split()


@query("visit_flags", f"select {', '.join(FLAG_COLS)}, count(*) as n from {{mart_rows}} group by all", **L_MART)
def visit_flags(dom):
    rows = patient_seen.mart_rows(_seen(dom), _tables(dom), AS_OF)
    return rows.groupBy(*FLAG_COLS).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- member reporting
PERIODS = """
    select * from {meas_period} union all
    select 'Rolling 12', '2023', date '2023-01-01', date '2023-12-31'"""
MONTHS = """
    select m.*, f.mrn from {mm} m left join (select distinct payer, lob, member_id, fact as mrn from {fact_member}
      where fact_shortdescr = 'PRI-MRN') f on m.payer = f.payer and m.lob = f.lob and m.member_id = f.member_id where m.member_months > 0"""
UV3 = f"""
    select distinct payer, lob, member_id, mrn from {{legacy}} where visit_status_type = 'SCHEDULED'
      and date_of_service between date '{AS_OF}' and date '{AS_OF}' + 180"""
COUNTS_SQL = {
    "npi": "uv.servicing_pcp_npi = uv.historical_pcp_npi",
    "prac": "uv.servicing_pcp_practice = uv.historical_pcp_practice",
    "pod": "uv.servicing_pcp_pod = uv.historical_pcp_pod",
    "sinai": "uv2.historical_pcp_practice is not null",
    "anyp": "uv.servicing_prov_pcp_spc = 'PCP'",
    "cms": "uv.servicing_prov_cms_pcp_spc = 'PCP'",
}


def _window_sql(name: str, from_year: str | None, part: str, history: str) -> str:
    """The row-level form: join every visit row, then running windows, then distinct."""
    year = f"and b.effyear >= '{from_year}'" if from_year else ""
    bits = ", ".join(f"if({cond}, 1, 0) as f_{k}" for k, cond in COUNTS_SQL.items())
    w = f"over (partition by payer, lob, member_id, mrn{part} order by effper_dt range unbounded preceding)"
    return f"""
      select distinct year(effper_dt) as reporting_year, dense_rank() over (partition by reporting_period order by effper_dt) as reporting_month,
        effper_dt as reporting_date, reporting_period, payer, lob, member_id, mrn, pcp_npi, pcp_provider, pcp_emp_status, pcp_spc, cms_pcp_spc,
        pcp_pod, pcp_practice, epic_status, provider_attribution_type, member_months, '{name}' as reporting_window, currently_attributed,
        max(f_npi) {w} as pcp_npi_visit, max(f_prac) {w} as pcp_practice_visit, max(f_pod) {w} as pcp_pod_visit,
        max(f_sinai) {w} as mt_sinai_visit, cast(sum(f_npi) {w} as bigint) as count_pcp_npi_visits,
        cast(sum(f_prac) {w} as bigint) as count_pcp_practice_visits, cast(sum(f_anyp) {w} as bigint) as count_any_pcp_npi_visits,
        cast(sum(f_cms) {w} as bigint) as count_any_cms_pcp_npi_visits,
        max(f_up) over (partition by effper_dt, reporting_period, payer, lob, member_id, mrn) as upcoming_appointments_rolling,
        0 as upcoming_appointments_ytd, 0 as upcoming_appointments_mssp, date '{AS_OF}' as load_dt
      from (
        select stg.payer, stg.lob, stg.member_id, stg.mrn, stg.effper_dt, stg.member_months, stg.attributed_pcp_npi as pcp_npi,
          strftime(b.start_dt, '%m/%d/%Y') || ' - ' || strftime(b.end_dt, '%m/%d/%Y') as reporting_period,
          p.full_name as pcp_provider, p.lvl2_emp_status as pcp_emp_status, p.pcp_spc, p.cms_pcp_spc, p.lvl3_subgroup as pcp_pod,
          p.lvl4_practice as pcp_practice, e.epic_status,
          if(stg.attributed_pcp_npi = x.attributed_pcp_npi, 'Currently Attributed', 'Historically Attributed') as provider_attribution_type,
          coalesce(x.currently_active, 'N') as currently_attributed, {bits},
          if(coalesce(uv3.member_id, uv3.mrn) is not null, 1, 0) as f_up
        from {{months}} stg join {{periods}} b on stg.effper_dt between b.start_dt and b.end_dt and b.measurement_period_desc = '{name}' {year}
        left join {{provider}} p on stg.attributed_pcp_npi = p.npi
        left join {{practice_status}} e on p.lvl4_practice = e.lvl4_practice
        left join {{active_members}} x on stg.payer = x.payer and stg.lob = x.lob and stg.member_id = x.member_id
        left join {{legacy}} uv on stg.payer is not distinct from uv.payer and stg.lob is not distinct from uv.lob
          and stg.member_id is not distinct from uv.member_id and stg.mrn is not distinct from uv.mrn
          and stg.effper_dt = date_trunc('month', uv.date_of_service)
        left join (select distinct payer, lob, member_id, mrn, historical_pcp_practice from {{legacy}} a join {{periods}} b
            on date_trunc('month', a.date_of_service) between b.start_dt and b.end_dt and b.measurement_period_desc = '{history}') uv2
          on uv.payer is not distinct from uv2.payer and uv.lob is not distinct from uv2.lob and uv.member_id is not distinct from uv2.member_id
          and uv.mrn is not distinct from uv2.mrn and uv.servicing_pcp_practice = uv2.historical_pcp_practice
        left join {{uv3}} uv3 on stg.payer is not distinct from uv3.payer and stg.lob is not distinct from uv3.lob
          and stg.member_id is not distinct from uv3.member_id and uv.mrn is not distinct from uv3.mrn)"""


PER = ", reporting_period"
MEMBER_ALL = " union all ".join(
    f"(select * from ({_window_sql(*args)}))"
    for args in (
        ("Rolling 12", None, "", "Rolling 12"),
        ("Calendar Year", "2019", PER, "Calendar Year"),
        ("MSSP", "2019", PER, "Calendar Year"),
    )
)
BEST = """pcp_npi_visit desc, pcp_practice_visit desc, pcp_pod_visit desc, mt_sinai_visit desc, count_pcp_npi_visits desc,
    count_pcp_practice_visits desc, count_any_pcp_npi_visits desc, count_any_cms_pcp_npi_visits desc,
    upcoming_appointments_rolling desc, upcoming_appointments_ytd desc, upcoming_appointments_mssp desc"""
REST = "pcp_npi nulls last, pcp_provider nulls last, epic_status nulls last, currently_attributed nulls last"
MEMBER_KEYS = "reporting_month, reporting_date, reporting_period, reporting_window, payer, lob, member_id"
MEMBER = f"""
    select * exclude (pick1, pick2) from (
      select *, row_number() over (partition by {MEMBER_KEYS} order by {BEST}, mrn desc nulls last, {REST}) as pick2 from (
        select *, row_number() over (partition by {MEMBER_KEYS}, coalesce(mrn, 'M') order by {BEST}, {REST}) as pick1 from {{member_all}})
      where pick1 = 1) where pick2 = 1"""
LEGACY = "select * from {visits} where visit_status_type in ('ARRIVED', 'SCHEDULED', 'COMPLETED')"
L_MEMBER = {**L_VISITS, "legacy": LEGACY, "periods": PERIODS, "months": MONTHS, "uv3": UV3, "member_all": MEMBER_ALL, "member_rep": MEMBER}
MEMBER_DATES = "replace (cast(reporting_date as varchar) as reporting_date, cast(load_dt as varchar) as load_dt)"


@query("unified_member", f"select * {MEMBER_DATES} from {{member_rep}}", **L_MEMBER)
def unified_member_query(dom):
    return unified_member.member_reporting(_tables(dom), stored(visits.legacy_visits(_visits(dom)), "legacy-visits"), AS_OF_DATE)


@query(
    "running_visit_measures",
    """select payer, lob, member_id, cast(month as varchar) as month,
         max(f) over w as pcp_npi_visit, cast(sum(n) over w as bigint) as count_pcp_npi_visits
       from (select payer, lob, member_id, date_trunc('month', date_of_service)::date as month,
               max(if(servicing_pcp_npi = historical_pcp_npi, 1, 0)) as f, sum(if(servicing_pcp_npi = historical_pcp_npi, 1, 0)) as n
             from {visits} group by 1, 2, 3, 4)
       window w as (partition by payer, lob, member_id order by month)""",
    **L_VISITS,
)
def running_visit_measures(dom):
    rows = _visits(dom)
    same = F.when(F.col("servicing_pcp_npi") == F.col("historical_pcp_npi"), 1).otherwise(0)
    monthly = rows.groupBy("payer", "lob", "member_id", F.trunc("date_of_service", "MM").alias("month")).agg(
        F.max(same).alias("pcp_npi_visit"), F.sum(same).alias("count_pcp_npi_visits"), *[F.lit(0).alias(n) for n in _OTHER]
    )
    out = unified_member.running_visit_measures(monthly, ["payer", "lob", "member_id"], "month")
    return out.select("payer", "lob", "member_id", "month", "pcp_npi_visit", "count_pcp_npi_visits")


_OTHER = [n for n in (*unified_member.FLAGS, *unified_member.COUNTS) if n not in ("pcp_npi_visit", "count_pcp_npi_visits")]


@query(
    "rolling_bounds",
    """select window_name, cast(case when loaded < date '2024-01-01' then lo + interval 1 month else lo end as date)::varchar as window_from,
         cast(last_day(case when loaded < date '2024-01-01' then hi + interval 1 month else hi end) as date)::varchar as window_to
       from (select 'rolling' as window_name, min(effper_dt) as lo, max(effper_dt) as hi, date '2023-12-10' as loaded from {member_months})""",
)
def rolling_bounds(dom):
    previous = dom.member_months.select(
        F.lit("Rolling 12").alias("reporting_window"), F.col("effper_dt").alias("reporting_date"), as_date("2023-12-10").alias("load_dt")
    )
    return unified_member.bounds_frame(previous, AS_OF).select(F.lit("rolling").alias("window_name"), "window_from", "window_to")


@query(
    "id_bridge",
    "select member_id, pri_mrn from {member} where pri_mrn is not null union select member_id, pri_mrn from {claim_header}",
)
def id_bridge_query(dom):
    known = dom.member.where(F.col("pri_mrn").isNotNull()).select("member_id", "pri_mrn")
    return id_bridge(known, dom.claim_header.select("member_id", "pri_mrn"))
