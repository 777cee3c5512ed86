"""Claims extract and GLP-1 queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimspark.functions import codes
from claimspark.functions.compat import keep_if_len, lpad_code, pad_if, recode
from claimspark.jobs import glp1, hcg
from claimspark.jobs.patient_seen import claim_procedure
from claimspark.operators import aggregate, reshape
from claimspark.plans.registry import query

AS_OF = "2024-01-20"
SLOTS = range(1, 31)

# --------------------------------------------------------------------------- GLP-1
GLP1 = """
    with_dx as (select distinct member from {med_claims} where substr(dx_code, 1, 3) in ('E08', 'E09', 'E10', 'E11', 'E13')),
    fills as (select * from {rx_fills} where fill_date between date '2024-01-01' and date '2024-01-15' and ndc <> 'OTHER'),
    classified as (
      select f.member, f.event_id, f.ndc, cast(f.fill_date as varchar) as fill_date,
        case when f.ndc = '0169-7501-12' then 'Weight Loss GLP1' else 'Diabetes GLP1' end as drug_category,
        case when d.member is null then 0 else 1 end as has_diabetes_dx,
        case when f.ndc = '0169-7501-12' then 'Weight Loss' when d.member is null then 'Likely Weight Loss'
          else 'Diabetes Management' end as final_category
      from fills f left join with_dx d on f.member = d.member)"""


def _glp1(dom):
    return glp1.classify_glp1(dom.rx_fills, dom.med_claims, "2024-01-01", "2024-01-15", member="member").select(
        "member", "event_id", "ndc", "fill_date", "drug_category", "has_diabetes_dx", "final_category"
    )


query("glp1_classification", f"select * from (with {GLP1} select * from classified)")(_glp1)


@query("glp1_freq", f"select * from (with {GLP1} select final_category, count(*) as n from classified group by 1)")
def glp1_freq(dom):
    return aggregate.freq(_glp1(dom), "final_category")


# --------------------------------------------------------------------------- claim lines
RANKED = """
    select *, cast(row_number() over (partition by payer, lob, member_id, claim_id
      order by lpad(revenue_code, 4, '0') desc nulls last, service_code desc nulls last, cpt_modifier1 desc nulls last,
        cpt_modifier2 desc nulls last, allowed_amount desc nulls last, paid_amount desc nulls last, unit_count desc nulls last,
        place_of_service desc nulls last, cap_claim_ind desc nulls last, service_dt desc nulls last, revenue_code desc nulls last,
        include_flag desc nulls last, line desc nulls last, k1 desc nulls last, k2 desc nulls last, k3 desc nulls last,
        k4 desc nulls last) as bigint) as rn
    from {fact_service} where member_id <> '00000000000000000000'"""


def _ranked(dom):
    return hcg.rank_claim_lines(_lines(dom))


def _lines(dom):
    """Service lines with the tie columns in the order the checking SQL uses."""
    ties = ["service_dt", "revenue_code", "include_flag", "line", "k1", "k2", "k3", "k4"]
    return dom.fact_service.select(*hcg.CLAIM_KEY, *hcg.LINE_ORDER, *ties)


@query(
    "claim_line_rank",
    """select payer, lob, member_id, claim_id, line, k1, k2, cast(service_dt as varchar) as service_dt,
       cast(allowed_amount as double) as allowed_amount, revenue_code, rn from {ranked}""",
    ranked=RANKED,
)
def claim_line_rank(dom):
    return _ranked(dom).select(*hcg.CLAIM_KEY, "line", "k1", "k2", "service_dt", "allowed_amount", "revenue_code", "rn")


@query(
    "allocate_header_paid",
    """select r.payer, r.lob, r.member_id, r.claim_id, r.rn, h.claim_type,
         cast(case when h.claim_type = 'Facility' and (r.payer like 'MSSP%' or r.payer in ('REACH', 'HNACO'))
           then case when r.rn = 1 then h.tcc_paid else 0 end else r.paid_amount end as double) as paid
       from {ranked} r left join {claim_header} h
         on r.payer = h.payer and r.lob = h.lob and r.member_id = h.member_id and r.claim_id = h.claim_id""",
    ranked=RANKED,
)
def allocate_header_paid(dom):
    header = dom.claim_header.select(*hcg.CLAIM_KEY, "claim_type", "tcc_paid")
    joined = _ranked(dom).join(header, hcg.CLAIM_SORT, "left")
    paid = hcg.allocate_header_paid(F.col("payer"), F.col("claim_type"), F.col("rn"), F.col("tcc_paid"), F.col("paid_amount"))
    return joined.select(*hcg.CLAIM_KEY, "rn", "claim_type", paid.alias("paid"))


@query(
    "claim_span",
    """select payer, lob, member_id, claim_id, cast(min(service_dt) as varchar) as from_date,
         cast(max(service_dt) as varchar) as to_date from {fact_service} group by 1, 2, 3, 4""",
)
def claim_span(dom):
    return aggregate.claim_span(dom.fact_service, hcg.CLAIM_KEY, "service_dt")


# --------------------------------------------------------------------------- slot pivots
DX = (
    """select payer, lob, member_id, claim_id, icd_version, """
    + ", ".join(f'max(code) filter (where slot = {i}) as "D{i}_D"' for i in SLOTS)
    + ", "
    + ", ".join(f'max(poa) filter (where slot = {i}) as "D{i}_P"' for i in SLOTS)
    + """ from (select payer, lob, member_id, claim_id, code, poa, try_cast(min(prmry_ind) as int) as slot,
            max(case code_desc when 'DXICD9' then '09' when 'DXICD10' then '10' end) as icd_version
          from {fact_dxpx} where code_desc like 'DX%' group by 1, 2, 3, 4, 5, 6) group by 1, 2, 3, 4, 5"""
)
PX = (
    """select payer, lob, member_id, claim_id, """
    + ", ".join(f'max(code) filter (where try_cast(prmry_ind as int) = {i}) as "D{i}_PR"' for i in SLOTS)
    + """ from {fact_dxpx} where code_desc like 'PX%' group by 1, 2, 3, 4"""
)


@query("dx_wide", DX)
def dx_wide(dom):
    return reshape.dx_wide(dom.fact_dxpx, hcg.CLAIM_KEY)


@query("px_wide", PX)
def px_wide(dom):
    return reshape.px_wide(dom.fact_dxpx, hcg.CLAIM_KEY)


# --------------------------------------------------------------------------- taxonomies
TAX_LONG = """select npi, prov_bus_mail_addr_postal_cd, ind, taxonomy_code, primary_switch from (""" + " union all ".join(
    f"select npi, prov_bus_mail_addr_postal_cd, '{i}' as ind, hc_prov_taxon_cd_{i} as taxonomy_code,"
    f" hc_prov_prim_taxon_switch_{i} as primary_switch from {{nppes}}"
    for i in range(1, 16)
) + ") where taxonomy_code is not null"
TAX_ONE = """
    select t.npi, t.prov_bus_mail_addr_postal_cd as zip_code, t.taxonomy_code, x.classification as primary_specialty,
      x.specialization, x.pcp_spc
    from (select *, row_number() over (partition by npi order by case when primary_switch = 'Y' then 0 else 1 end, ind,
            taxonomy_code) as pick from {tax_long}) t
    left join {taxonomy_xwalk} x on t.taxonomy_code = x.code where t.pick = 1"""


@query("taxonomy_long", "select * from {tax_long}", tax_long=TAX_LONG)
def taxonomy_long(dom):
    return reshape.taxonomy_long(dom.nppes, ["npi", "prov_bus_mail_addr_postal_cd"])


@query("primary_taxonomy", "select * from {tax_one}", tax_long=TAX_LONG, tax_one=TAX_ONE)
def primary_taxonomy(dom):
    return reshape.primary_taxonomy(dom.nppes, dom.taxonomy_xwalk)


# --------------------------------------------------------------------------- the whole extract
POS_OK = ", ".join(f"'{c}'" for c in codes.PLACE_CODES)
GENDER_SQL = "case upper(m.gender) when 'M' then 'M' when 'MALE' then 'M' when 'F' then 'F' when 'FEMALE' then 'F' end"
POS_SQL = (
    "case when length({c}) <= 2 and lpad({c}, 2, '0') in (" + POS_OK + ") then lpad({c}, 2, '0') end"
)
ADMIT_SQL = """case when {c} in ('NEW BORN', 'NEWBORN') then '4' when {c} = 'ELECTIVE' then '3'
    when {c} in ('EMERGENT', 'EMERGENCY') then '1' when {c} = 'INFORMATION NOT AVAILABLE' then '9' when {c} = 'URGENT' then '2'
    when {c} = 'TRAUMA CENTER' then '5' when {c} = 'RESERVED FOR NATIONAL ASSIGNMENT' then '6' end"""
STATUS_SQL = "case {c} when '0' then 'D' when '-1' then 'R' else 'P' end"
LOB_SQL = "case {c} when 'Commercial' then 'COM' when 'MA' then 'ADV' when 'Medicare' then 'MCR' when 'Medicaid' then 'MCD' else 'UNK' end"
DRGV_SQL = "case when {c} in ('DRG - AP', 'DRG - APR', 'DRG - MS') then substr({c}, 7) end"


def _extract_sql() -> str:
    blanks = (
        "linenum providercounty renderingprovidercounty medicareid admitsource cob copay coinsurance deductible patientpay admitdiag"
        " riskpool oon loinc county memberstatus userdefpop2 userdefpop3 userdefnum1 userdefnum2 userdefnum3"
    ).split()
    cols = [
        """row_number() over (partition by s.payer, s.lob order by s.member_id, s.claim_id, s.rn, dx.icd_version nulls last,
             p.fact nulls last, g.fact nulls last) as sequencenumber""",
        "s.payer", "s.claim_id as claimid", "s.member_id as contractid", "s.member_id as memberid",
        "cast(m.dob as varchar) as dob", f"{GENDER_SQL} as gender",
        "cast(sp.lo as varchar) as fromdate", "cast(sp.hi as varchar) as todate",
        "cast(h.admit_date as varchar) as admitdate", "cast(h.discharge_date as varchar) as dischdate",
        "cast(h.paid_date as varchar) as paiddate", "lpad(h.drg, 4, '0') as drg", DRGV_SQL.format(c="h.drg_desc") + " as drgversion",
        "case when length(s.revenue_code) <= 4 then lpad(s.revenue_code, 4, '0') end as revcode", "s.service_code as hcpcs",
        "s.cpt_modifier1 as modifier", "s.cpt_modifier2 as modifier2", "s.place_of_service as srcpos",
        POS_SQL.format(c="s.place_of_service") + " as pos", "substr(x.specialization, 1, 28) as srcspecialty",
        "ms.milliman_specialty as specialty", "case when length(s.cap_claim_ind) <= 1 then s.cap_claim_ind end as encounterflag",
        "h.servicing_npi as providerid", "substr(x.zip_code, 1, 5) as providerzip", "h.servicing_npi as renderingproviderid",
        "substr(x.zip_code, 1, 5) as renderingproviderzip", "h.bill_code_ub as billtype",
        ADMIT_SQL.format(c="h.ip_admit_type") + " as admittype", "'0.1' as billed", "cast(s.allowed_amount as double) as allowed",
        """cast(case when h.claim_type = 'Facility' and (s.payer like 'MSSP%' or s.payer in ('REACH', 'HNACO'))
             then case when s.rn = 1 then h.tcc_paid else 0 end else s.paid_amount end as double) as paid""",
        "cast(h.discharge_date - h.admit_date as int) as days", "cast(s.unit_count as double) as units",
        "h.discharge_disposition as dischargestatus", "dx.icd_version as icdversion",
        *[f'dx."D{i}_D" as icddiag{i}' for i in SLOTS], *[f'dx."D{i}_P" as poa{i}' for i in SLOTS],
        *[f'px."D{i}_PR" as icdproc{i}' for i in SLOTS],
        STATUS_SQL.format(c="h.paid_status") + " as claimlinestatus", "h.paid_status as currentallowed", "s.lob as srclob",
        LOB_SQL.format(c="s.lob") + " as lob", "p.fact as srcproduct", "p.fact as product", "g.fact as groupid",
        "substr(m.zip, 1, 5) as zip", "s.payer as userdefpop1", f"'{AS_OF}' as load_date",
        *[f"cast(null as varchar) as {b}" for b in blanks],
    ]
    on4 = lambda a: f"s.payer = {a}.payer and s.lob = {a}.lob and s.member_id = {a}.member_id and s.claim_id = {a}.claim_id"
    on3 = lambda a: f"s.payer = {a}.payer and s.lob = {a}.lob and s.member_id = {a}.member_id"
    return f"""
      select {', '.join(cols)}
      from (select r.* from {{ranked}} r join (select distinct payer, lob from {{control}} where is_curr_flg = 1) using (payer, lob)) s
      left join {{claim_header}} h on {on4('h')}
      left join {{member}} m on {on3('m')}
      left join (select payer, lob, member_id, claim_id, min(service_dt) as lo, max(service_dt) as hi from {{fact_service}}
                 group by all) sp on {on4('sp')}
      left join {{tax_one}} x on h.servicing_npi = x.npi
      left join {{specialty_xwalk}} ms on x.taxonomy_code = ms.taxonomy_code
      left join {{dx}} dx on {on4('dx')}
      left join {{px}} px on {on4('px')}
      left join (select distinct payer, lob, member_id, fact from {{fact_member}} where fact_category = 'Member Coverage'
                 and fact_shortdescr = 'Product') p on {on3('p')}
      left join (select distinct payer, lob, member_id, fact from {{fact_member}} where fact_category = 'Group Identifiers'
                 and fact_shortdescr = 'Group Number') g on {on3('g')}"""


EXTRACT = {"ranked": RANKED, "tax_long": TAX_LONG, "tax_one": TAX_ONE, "dx": DX, "px": PX}


def _family(dom):
    names = ("claim_header", "member", "nppes", "taxonomy_xwalk", "specialty_xwalk", "fact_dxpx", "fact_member")
    return {**{n: dom.table(n) for n in names}, "fact_service": _lines(dom)}


@query("hcg_claims", _extract_sql(), **EXTRACT)
def hcg_claims(dom):
    family = hcg.bucket_facts(_family(dom))
    return hcg.load_hcg(dom.control, family, family, AS_OF)


@query(
    "hcg_load_counts",
    f"select srclob, payer, count(*) as record_count from ({_extract_sql()}) group by 1, 2",
    **EXTRACT,
)
def hcg_load_counts(dom):
    return aggregate.load_counts(hcg_claims(dom), ["srclob", "payer"])


@query(
    "control_branches",
    """select payer, lob, case when payer like 'MSSP%' or payer = 'REACH' then 'A' when payer = 'HNACO' then 'B' else 'C' end as branch
       from {control} where is_curr_flg = 1 group by 1, 2""",
)
def control_branches(dom):
    return hcg.control_branches(dom.control)


# --------------------------------------------------------------------------- code recodes
@query(
    "recode_suite",
    f"""select h.claim_id, {DRGV_SQL.format(c='h.drg_desc')} as drg_version, {ADMIT_SQL.format(c='h.ip_admit_type')} as admit_type,
          {STATUS_SQL.format(c='h.paid_status')} as line_status, {LOB_SQL.format(c='h.lob')} as lob_code, {GENDER_SQL} as gender,
          lpad(h.drg, 4, '0') as drg4, case when length(h.bill_code_ub) <= 2 then lpad(h.bill_code_ub, 2, '0') end as bill2,
          case when length(h.bill_code_ub) <= 1 then h.bill_code_ub end as bill1,
          coalesce(case h.discharge_disposition when '01' then 'home' when '02' then 'transfer' end, 'other') as disposition
        from {{claim_header}} h left join {{member}} m on h.payer = m.payer and h.lob = m.lob and h.member_id = m.member_id""",
)
def recode_suite(dom):
    member = dom.member.select("payer", "lob", "member_id", "gender")
    c = F.col
    return dom.claim_header.join(member, ["payer", "lob", "member_id"], "left").select(
        "claim_id",
        codes.drg_version(c("drg_desc")).alias("drg_version"),
        codes.admit_type(c("ip_admit_type")).alias("admit_type"),
        codes.paid_status(c("paid_status")).alias("line_status"),
        codes.lob_code(c("lob")).alias("lob_code"),
        codes.gender_code(c("gender")).alias("gender"),
        lpad_code(c("drg"), 4).alias("drg4"),
        pad_if(c("bill_code_ub"), 2).alias("bill2"),
        keep_if_len(c("bill_code_ub"), 1).alias("bill1"),
        recode(c("discharge_disposition"), {"01": "home", "02": "transfer"}, "other").alias("disposition"),
    )


@query(
    "pos_normalize",
    f"""select place_of_service, {POS_SQL.format(c='place_of_service')} as pos, count(*) as n, cast(sum(allowed_amount) as double) as allowed
        from {{fact_service}} group by 1, 2""",
)
def pos_normalize(dom):
    pos = codes.normalize_pos(F.col("place_of_service")).alias("pos")
    return dom.fact_service.groupBy("place_of_service", pos).agg(
        F.count(F.lit(1)).alias("n"), F.sum("allowed_amount").alias("allowed")
    )


@query(
    "claim_procedure",
    """select payer, lob, member_id, claim_id, cast(service_dt as varchar) as service_dt, service_code, excl_code, incl_code, proc_code_desc
       from (select f.*, e.proc_code as excl_code, i.proc_code as incl_code, coalesce(e.proc_code_description, i.proc_name) as proc_code_desc,
               row_number() over (partition by payer, lob, member_id, claim_id, service_dt
                 order by e.proc_code nulls last, i.proc_code desc nulls last, service_code nulls last) as pick
             from {fact_service} f left join {excluded_list} e on f.service_code = e.proc_code
             left join {los_list} i on f.service_code = i.proc_code where f.service_dt >= date '2019-01-01') where pick = 1""",
)
def claim_procedure_query(dom):
    return claim_procedure(dom.fact_service, dom.excluded_list, dom.los_list).select(
        "payer", "lob", "member_id", "claim_id", "service_dt", "service_code", "excl_code", "incl_code", "proc_code_desc"
    )


