"""The healthcare tables, derived from the shared TPC-H-like tables.

Each entry is one SELECT in the SQL subset that Spark and DuckDB share, so the same rows feed a
Spark job and the independent SQL that checks it. ``{name}`` refers to another entry or to a base
table. Only inputs are derived here; no operator of the package is used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "benchmark", "pages",
    "conversations", "embeddings",
)


def npi(expr: str) -> str:
    return f"'1' || lpad(cast({expr} as string), 9, '0')"


def shifted(col: str) -> str:
    """Order and ship dates moved 23 years on, so that they meet the events of January 2024."""
    return f"cast(cast({col} as date) + interval '23' year as date)"


def member_id(key: str) -> str:
    return (
        f"case when {key} % 211 = 5 then '00000000000000000000' when {key} % 89 = 3 then 'A?' || cast({key} as string)"
        f" when {key} % 83 = 4 then 'Subscriber' || cast({key} as string)"
        f" else 'C' || lpad(cast({key} as string), 10, '0') end"
    )


def mrn(key: str) -> str:
    return f"case when {key} % 7 = 0 then null else 'M' || cast({key} - {key} % 2 as string) end"


def dec(expr: str) -> str:
    return f"cast({expr} as decimal(18,2))"


EVENT_STATUS = (
    "case event_type when 'click' then 'Completed' when 'purchase' then 'Scheduled' when 'view' then 'Cancelled'"
    " when 'error' then 'NoShow' else 'Arrived' end"
)
EVENT_CODE = (
    "case event_type when 'click' then '0' when 'purchase' then '1' when 'view' then '2' when 'error' then '3' else '4' end"
)

TABLES: dict[str, str] = {
    # one row per customer: the keys every member table shares
    "who": f"""
        select c_custkey as ck, c_name, c_acctbal, n_name, n_nationkey,
          case c_mktsegment when 'BUILDING' then 'MSSP TRACK ONE PLUS' when 'AUTOMOBILE' then 'HNACO'
            when 'MACHINERY' then 'REACH' when 'HOUSEHOLD' then 'AETNA' else 'EMBLEM' end as payer,
          case n_regionkey when 0 then 'Commercial' when 1 then 'MA' when 2 then 'Medicare' when 3 then 'Medicaid'
            else 'Exchange' end as lob,
          {member_id('c_custkey')} as member_id,
          {mrn('c_custkey')} as pri_mrn
        from {{customer}} join {{nation}} on c_nationkey = n_nationkey""",
    "control": """
        select distinct payer, lob, 'P_' || payer as partition_name, 'SP_' || payer || '_' || lob as subpartition_name,
          case when payer = 'AETNA' and lob = 'MA' then 0 else 1 end as is_curr_flg
        from {who}""",
    "member": """
        select payer, lob, member_id, pri_mrn, cast(date '1950-01-01' + cast(ck % 20000 as int) as date) as dob,
          case ck % 5 when 0 then 'm' when 1 then 'FEMALE' when 2 then 'U' when 3 then cast(null as string) else 'Male' end as gender,
          lpad(cast(ck as string), 5, '0') || '-1234' as zip,
          case when ck % 50 = 0 then cast(date '2020-01-01' + cast(ck % 300 as int) as date) end as death_dt,
          c_name as full_name
        from {who} where member_id <> '00000000000000000000'""",
    "claim_header": f"""
        select payer, lob, member_id, cast(o_orderkey as string) as claim_id, pri_mrn,
          substr(cast({shifted('o_orderdate')} as string), 1, 7) as effper,
          {shifted('o_orderdate')} as date_of_service,
          case when o_orderstatus = 'F' then {shifted('o_orderdate')} end as admit_date,
          case when o_orderstatus = 'F' then cast({shifted('o_orderdate')} + cast(o_orderkey % 10 as int) as date) end as discharge_date,
          cast({shifted('o_orderdate')} + 30 as date) as paid_date,
          case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 20000 as string) end as drg,
          case o_orderkey % 4 when 0 then 'DRG - AP' when 1 then 'DRG - APR' when 2 then 'DRG - MS' else 'DRG - X' end as drg_desc,
          case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Facility'
            when o_orderpriority = '5-LOW' then 'Pharmacy' else 'Professional' end as claim_type,
          case o_orderstatus when 'O' then 'Outpatient' when 'F' then 'Inpatient' else 'Professional' end as claim_category,
          case o_orderkey % 6 when 0 then 'Office Visit - PCP Visit' when 1 then 'Hospital'
            when 2 then 'Office Visit - Specialty Consult' when 3 then 'Clinic' when 4 then 'Lab' else 'Clinic' end as claim_place_of_service,
          case when o_orderkey % 31 = 0 then null when o_orderkey % 37 = 0 then '1013360528'
            else {npi('o_orderkey % 120')} end as servicing_npi,
          'T' || cast(o_orderkey % 120 as string) as servicing_tin,
          {npi('o_orderkey % 90')} as attending_npi,
          'T' || cast(o_orderkey % 90 as string) as attending_tin,
          cast(o_orderkey % 900 as string) as bill_code_ub,
          case o_orderkey % 8 when 0 then 'NEW BORN' when 1 then 'ELECTIVE' when 2 then 'EMERGENT' when 3 then 'URGENT'
            when 4 then 'TRAUMA CENTER' when 5 then 'INFORMATION NOT AVAILABLE' when 6 then 'OTHER'
            else 'RESERVED FOR NATIONAL ASSIGNMENT' end as ip_admit_type,
          lpad(cast(o_orderkey % 70 as string), 2, '0') as discharge_disposition,
          case o_orderkey % 5 when 0 then '1' when 1 then '0' when 2 then '-1' when 3 then cast(null as string) else '9' end as paid_status,
          {dec('o_totalprice')} as tcc_paid,
          case when o_orderkey % 11 = 0 then 'N' else 'Y' end as include_flag,
          case when o_orderkey % 13 = 0 then 'E' || cast(o_orderkey as string) end as ip_episode_key,
          case when o_orderkey % 17 = 0 then 'E' || cast(o_orderkey as string) end as ed_episode_key
        from {{orders}} join {{who}} on o_custkey = ck""",
    "fact_service": f"""
        select payer, lob, member_id, cast(l_orderkey as string) as claim_id, {shifted('l_shipdate')} as service_dt,
          case when l_partkey % 20 = 0 then 'G0438' when l_partkey % 20 = 1 then 'G0402'
            else 'S' || cast(l_partkey % 40 as string) end as service_code,
          case when l_suppkey % 9 = 0 then null else cast(l_suppkey * 131 as string) end as revenue_code,
          nullif(l_returnflag, 'N') as cpt_modifier1,
          nullif(l_linestatus, 'F') as cpt_modifier2,
          case when l_partkey % 23 = 0 then null else cast(l_partkey % 100 as string) end as place_of_service,
          case l_partkey % 3 when 0 then 'Y' when 1 then 'NO' else cast(null as string) end as cap_claim_ind,
          {dec('l_extendedprice')} as allowed_amount,
          {dec(dec('l_extendedprice') + ' - ' + dec('l_quantity'))} as paid_amount,
          {dec('l_quantity')} as unit_count,
          case when l_linenumber = 7 then 'N' else 'Y' end as include_flag,
          l_linenumber as line, l_partkey as k1, l_suppkey as k2, l_discount as k3, l_tax as k4
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{who}} on o_custkey = ck""",
    "nppes": """
        select '1' || lpad(cast(s_suppkey as string), 9, '0') as npi,
          lpad(cast(s_suppkey * 7 as string), 5, '0') || '0001' as prov_bus_mail_addr_postal_cd, """
    + ", ".join(
        f"case when (s_suppkey + {i}) % {3 + i % 4} = 0 then null else 'X' || cast((s_suppkey * {i}) % 17 as string) end"
        f" as hc_prov_taxon_cd_{i}"
        for i in range(1, 16)
    )
    + ", "
    + ", ".join(
        f"case when (s_suppkey + {i}) % 19 = 0 then 'Y' when s_suppkey % 4 = 0 then null else 'N' end"
        f" as hc_prov_prim_taxon_switch_{i}"
        for i in range(1, 16)
    )
    + " from {supplier}",
    "taxonomy_xwalk": """
        select 'X' || cast(n_nationkey as string) as code, 'CLASS ' || cast(n_nationkey % 5 as string) as classification,
          n_name || ' specialization of the provider' as specialization,
          case when n_nationkey % 2 = 0 then 'PCP' else 'SPC' end as pcp_spc
        from {nation} where n_nationkey < 14""",
    "specialty_xwalk": """
        select 'X' || cast(n_nationkey as string) as taxonomy_code, 'M' || cast(n_nationkey as string) as milliman_specialty
        from {nation} where n_nationkey < 12""",
    "fact_dxpx": """
        select payer, lob, member_id, cast(l_orderkey as string) as claim_id,
          case when l_partkey % 30 = 0 then cast(null as string) else 'D' || cast(l_partkey % 500 as string) end as code,
          case when l_suppkey % 4 = 0 then 'PXICD10' when l_orderkey % 6 = 0 and l_suppkey % 3 = 0 then 'DXICD9' else 'DXICD10' end as code_desc,
          l_returnflag as poa,
          case when l_partkey % 41 = 0 then 'x' when l_suppkey % 5 = 0 then cast(l_linenumber + 9 as string)
            else cast(l_linenumber as string) end as prmry_ind
        from {lineitem} join {orders} on l_orderkey = o_orderkey join {who} on o_custkey = ck""",
    "fact_member": """
        select payer, lob, member_id, 'Member Coverage' as fact_category, 'Product' as fact_shortdescr,
          'PROD' || cast(ck % 4 as string) as fact from {who}
        union all select payer, lob, member_id, 'Member Coverage', 'Product', 'PLUS' from {who} where ck % 6 = 0
        union all select payer, lob, member_id, 'Group Identifiers', 'Group Number', 'G' || cast(ck % 20 as string)
          from {who} where ck % 9 <> 0
        union all select case when ck % 29 = 0 then 'ANY' else payer end, lob, member_id, 'Member Identifiers', 'PRI-MRN',
          case when ck % 23 = 0 then '0' else 'M' || cast(ck - ck % 2 as string) end from {who}
        union all select payer, lob, member_id, 'Member Identifiers', 'SUBSCRIBER', 'X' || cast(ck as string) from {who}""",
    "provider": f"""
        select {npi('s_suppkey')} as npi,
          case s_suppkey % 3 when 0 then 'Employed' when 1 then 'Voluntary' else 'Not Affiliated' end as lvl2_emp_status,
          case s_suppkey % 6 when 0 then '23 - Ryan Health' when 1 then '07 - One Medical' when 2 then '80 - Requires Investigation'
            when 3 then cast(null as string) else 'POD ' || cast(s_suppkey % 6 as string) end as lvl3_subgroup,
          case when s_suppkey % 10 = 9 then null else n_name end as lvl4_practice,
          case when s_suppkey % 2 = 0 then 'E' else 'V' end as lvl5_prac_emp_status,
          s_name as full_name, 'T' || cast(s_suppkey as string) as default_tin,
          case when s_suppkey % 2 = 0 then 'PCP' else 'SPC' end as pcp_spc,
          case when s_suppkey % 4 = 0 then 'PCP' when s_suppkey % 4 = 1 then 'SPC' else cast(null as string) end as cms_pcp_spc
        from {{supplier}} join {{nation}} on s_nationkey = n_nationkey""",
    "practice_status": """
        select n_name as lvl4_practice,
          case n_nationkey % 3 when 0 then 'EPIC' when 1 then 'NON-EPIC' else cast(null as string) end as epic_status
        from {nation} where n_nationkey < 20""",
    "member_months": f"""
        select payer, lob, member_id, substr(cast({shifted('o_orderdate')} as string), 1, 7) as effper,
          cast(date_trunc('month', {shifted('o_orderdate')}) as date) as effper_dt,
          case o_orderkey % 5 when 0 then cast(null as int) when 1 then 0 else 1 end as member_months,
          case when o_orderkey % 19 = 0 then null else {npi('o_orderkey % 110')} end as attributed_pcp_npi,
          'T' || cast(o_orderkey % 110 as string) as attributed_pcp_tax_id
        from {{orders}} join {{who}} on o_custkey = ck""",
    "active_members": f"""
        select payer, lob, case when ck % 5 = 0 then 'EMP' || cast(ck as string) else member_id end as member_id,
          case when ck % 4 = 0 then 'N' else 'Y' end as currently_active,
          case when ck % 21 = 0 then null else {npi('ck % 110')} end as attributed_pcp_npi,
          'POD ' || cast(ck % 6 as string) as pcp_lvl3_pod, n_name as pcp_lvl4_practice,
          '2024-0' || cast(ck % 8 + 1 as string) as latest_active_month
        from {{who}} where member_id <> '00000000000000000000'""",
    "id_xwalk": """
        select 'EMP' || cast(ck as string) as member_id, member_id as member_id_token from {who} where ck % 5 = 0""",
    "visit_reason": """
        select event_id as pat_enc_csn_id, event_id % 6 as enc_reason_id from {events} where event_id % 2 = 0""",
    "reason_name": """
        select r_regionkey as reason_visit_id, case r_regionkey when 0 then 'Annual Physical'
          when 1 then 'Medicare Annual Wellness Visit' when 2 then 'Sick visit' when 3 then 'ANNUAL' else 'Follow up' end as reason_visit_name
        from {region}""",
    "patient_access": f"""
        select 'M' || cast(user_id - user_id % 2 as string) as mrn, ts as appt_dttm, event_id as pat_enc_csn_id,
          {EVENT_STATUS} as appt_status_name,
          case when event_id % 41 = 0 then null else {npi('event_id % 120')} end as npi
        from {{events}} where event_id % 3 = 0""",
    "sched_appt": f"""
        select 'P' || cast(user_id as string) as pat_id, 'PR' || cast(event_id % 120 as string) as prov_id,
          {EVENT_CODE} as appt_status_c, ts as appt_dttm, event_id as pat_enc_csn_id
        from {{events}} where event_id % 3 = 1""",
    "patient": """
        select 'M' || cast(ck - ck % 2 as string) as y_mrn, 'P' || cast(ck as string) as pat_id from {who}
        union all select 'M' || cast(ck - ck % 2 as string), 'P' || cast(ck as string) from {who} where ck % 2 = 0""",
    "provider_id": f"""
        select 'PR' || cast(s_suppkey as string) as prov_id, {npi('s_suppkey')} as npi from {{supplier}}
        union all select 'PR' || cast(s_suppkey as string), {npi('s_suppkey')} from {{supplier}} where s_suppkey % 3 = 0""",
    "appt_status": """
        select cast(r_regionkey as string) as appt_status_c, case r_regionkey when 0 then 'Completed' when 1 then 'Scheduled'
          when 2 then 'Canceled' when 3 then 'No Show' else 'Arrived' end as name,
          case r_regionkey when 0 then 'COMPLETED' else 'OTHER' end as title
        from {region}""",
    "ryan_scheduling": f"""
        select 'R' || cast(user_id as string) as identifier1,
          case when event_id % 4 = 0 then 'plain' || cast(user_id as string) when event_id % 28 = 1 then cast(null as string)
            else '13001_X' || cast(user_id as string) end as identifier2,
          ts as apptdate, case event_type when 'purchase' then 'SCHEDULED' when 'click' then 'ARRIVED' when 'view' then 'CANCELLED'
            else 'NOSHOW' end as apptstatus,
          {npi('event_id % 120')} as apptprovidernpi, cast(cast(ts as date) + cast(event_id % 3 as int) as date) as load_date,
          event_id as row_id
        from {{events}} where event_id % 3 = 2""",
    "encounter": f"""
        select 'P' || cast(user_id as string) as pat_id, event_id as pat_enc_csn_id, cast(ts as date) as contact_date,
          event_id % 8 as department_id,
          case event_id % 5 when 0 then '50' when 1 then cast(null as string) else '101' end as enc_type_c,
          case when event_id % 4 = 0 then 'Y' when event_id % 4 = 1 then null else 'N' end as enc_closed_yn,
          {EVENT_CODE} as appt_status_c, event_id % 14 as los_prime_proc_id, 'PR' || cast(event_id % 120 as string) as visit_prov_id
        from {{events}} where event_id % 3 = 0 and event_id % 10 <> 9""",
    "department": "select cast(n_nationkey as bigint) as department_id, 'DEPT ' || n_name as department_name from {nation} where n_nationkey < 7",
    "procedure": """
        select cast(n_nationkey as bigint) as proc_id, 'S' || cast(n_nationkey as string) as proc_code, 'PROC ' || n_name as proc_name
        from {nation} where n_nationkey < 12""",
    "enc_type": """
        select case r_regionkey when 0 then '50' else '10' || cast(r_regionkey as string) end as disp_enc_type_c,
          'ENC ' || r_name as name from {region}""",
    "ser_provider": """
        select 'PR' || cast(s_suppkey as string) as prov_id, s_name as prov_name, cast(s_suppkey % 7 as string) as provider_type_c
        from {supplier}""",
    "ser_title": "select cast(n_nationkey as string) as service_type_c, 'TITLE ' || n_name as title from {nation} where n_nationkey < 6",
    "dept_grouper": """
        select cast(n_nationkey as bigint) as grouper_records_numeric_id, 'GROUP ' || n_name as grouper_name
        from {nation} where n_nationkey < 8 and n_nationkey % 3 <> 2""",
    "los_list": """
        select cast(n_nationkey as bigint) as proc_id, 'S' || cast(n_nationkey as string) as proc_code, 'LOS ' || n_name as proc_name
        from {nation} where n_nationkey < 12 and n_nationkey % 2 = 0""",
    "excluded_list": """
        select 'S' || cast(n_nationkey as string) as proc_code, 'EXCL ' || n_name as proc_code_description
        from {nation} where n_nationkey % 3 = 0""",
    "provider_type_list": """
        select cast(n_nationkey as string) as provider_type_c, 'TYPE ' || n_name as provider_type from {nation} where n_nationkey in (0, 2, 3, 5)""",
    "place_list": """
        select distinct claim_place_of_service from {claim_header} where claim_place_of_service in ('Hospital', 'Clinic', 'Office Visit - PCP Visit')""",
    "management_reporting": f"""
        select case when payer like '%MSSP%' then 'MSSP NYMP' else payer end as payer, lob, member_id, min(pri_mrn) as pri_mrn,
          substr(cast({shifted('o_orderdate')} as string), 1, 7) as effper,
          min(cast(substr(cast({shifted('o_orderdate')} as string), 1, 4) as int)) as effyear,
          min(case when o_orderkey % 3 = 0 then null else {npi('o_orderkey % 110')} end) as npi,
          min(case when o_orderkey % 2 = 0 then 'E' else 'V' end) as prac_emp_status,
          min(case when o_orderkey % 5 = 0 then 'E' else 'V' end) as pcp_emp_status,
          min(case when o_orderkey % 2 = 0 then 'Y' else 'N' end) as crnt_pyr,
          min(case when o_orderkey % 3 = 0 then 'N' else 'Y' end) as vbc_flag
        from {{orders}} join {{who}} on o_custkey = ck group by 1, 2, 3, 5""",
    "epic_pcp": f"""
        select 'M' || cast(ck as string) as mrn, {npi('ck % 115')} as npi, 'PCP' as relationship_type from {{who}} where ck % 6 = 2""",
    "meas_period": """
        select 'Calendar Year' as measurement_period_desc, cast(2018 + n_nationkey as string) as effyear,
          cast(date '2018-01-01' + interval '1' year * n_nationkey as date) as start_dt,
          cast(date '2018-12-01' + interval '1' year * n_nationkey as date) as end_dt
        from {nation} where n_nationkey < 7
        union all select 'MSSP', cast(2018 + n_nationkey as string),
          cast(date '2018-07-01' + interval '1' year * n_nationkey as date), cast(date '2019-06-01' + interval '1' year * n_nationkey as date)
        from {nation} where n_nationkey < 6""",
    # drug reference
    "ndc_price": f"""
        select cast(l_partkey as string) as ndc,
          case l_suppkey % 5 when 0 then '09' when 1 then '23' when 2 then '24' when 3 then '25' else '99' end as npt_type,
          {dec('l_extendedprice')} as npt_pricex,
          case when l_orderkey % 97 = 0 then '00000000'
            else substr(cast(cast(l_shipdate as date) as string), 1, 4) || substr(cast(cast(l_shipdate as date) as string), 6, 2)
              || substr(cast(cast(l_shipdate as date) as string), 9, 2) end as npt_datec,
          l_orderkey as row_a, l_linenumber as row_b
        from {{lineitem}}""",
    "ndc_master": """
        select cast(p_partkey as string) as ndc, cast(p_partkey - p_partkey % 3 as string) as gcn_seqno, 'L' || cast(p_partkey % 40 as string) as lblrid,
          p_name as ln, p_name || ' 60' as ln60, p_brand as bn,
          case p_partkey % 4 when 0 then 'F' when 1 then 'O' when 2 then 'Q' else cast(null as string) end as cl,
          cast(p_partkey % 5 as string) as df, cast(p_size % 8 as string) as dea, 'B' || cast(p_partkey % 9 as string) as obc,
          cast(p_partkey % 2 as string) as maint, cast(p_partkey % 3 as string) as ndcgi1, cast(p_partkey % 2 as string) as gpi,
          cast(p_partkey % 6 as string) as gti, case when p_partkey % 13 = 0 then cast(null as string) else cast(p_partkey % 4 as string) end as gni,
          cast(p_size % 3 as string) as innov, cast(p_partkey % 2 as string) as repack, cast(p_partkey % 3 as string) as stpk,
          'SP' as shlf_pck, p_type as pd, cast(p_partkey % 3 as string) as uu, cast(p_size % 2 as string) as ud, cast(p_size as string) as ps,
          case when p_partkey % 10 = 0 then '00000000' else '2020' || lpad(cast(p_partkey % 12 + 1 as string), 2, '0') || '15' end as daddnc,
          case when p_partkey % 7 = 0 then cast(null as string) else '20210' || cast(p_partkey % 9 + 1 as string) || '01' end as dupdc,
          case when p_partkey % 5 = 0 then '20221231' else '00000000' end as obsdtec
        from {part}""",
    "ndc_medid": "select cast(p_partkey as string) as ndc, cast(p_partkey - p_partkey % 2 as string) as medid from {part} where p_partkey % 11 <> 0",
    "med": """
        select cast(p_partkey as string) as medid, 'MED ' || p_name as med_medid_desc, 'MG' as med_strength_uom,
          cast(p_partkey - p_partkey % 5 as string) as routed_dosage_form_med_id, cast(p_partkey - p_partkey % 7 as string) as generic_medid
        from {part} where p_partkey % 10 <> 4""",
    "routed_df_med": """
        select cast(p_partkey as string) as routed_dosage_form_med_id, 'RDF ' || p_name as med_routed_df_med_id_desc,
          cast(p_partkey - p_partkey % 4 as string) as routed_med_id from {part} where p_partkey % 20 <> 5""",
    "routed_med": "select cast(p_partkey as string) as routed_med_id, 'RM ' || p_name as med_routed_med_id_desc from {part} where p_partkey % 19 <> 8",
    "routed_gen_ndc": "select cast(p_partkey as string) as ndc, cast(p_partkey - p_partkey % 6 as string) as routed_gen_id from {part} where p_partkey % 3 <> 1",
    "routed_gen": "select cast(p_partkey as string) as routed_gen_id, 'RG ' || p_name as routed_gen_desc from {part} where p_partkey % 15 <> 6",
    "labeler": "select 'L' || cast(n_nationkey as string) as lblrid, n_name as mfg, cast(n_nationkey % 2 as string) as lblrind from {nation}",
    "gcn_link": "select cast(p_partkey as string) as gcn_seqno, cast(p_partkey * 3 as string) as gcn from {part} where p_partkey % 28 <> 12",
    "gcn_master": """
        select cast(p_partkey as string) as gcn_seqno, cast(p_partkey % 20 as string) as tc, 'H' || cast(p_partkey % 25 as string) as hic3,
          cast(p_partkey - p_partkey % 8 as string) as hicl_seqno, 'G' || cast(p_partkey % 15 as string) as gtc, 'DF' || cast(p_partkey % 12 as string) as gcdf,
          'RT' || cast(p_partkey % 8 as string) as gcrt, 'STR' || cast(p_partkey % 30 as string) as str,
          'S60' || cast(p_partkey % 30 as string) as str60, cast(p_partkey % 6 as string) as dcc
        from {part} where p_partkey % 29 <> 9""",
    "hicl": "select cast(p_partkey as string) as hicl_seqno, 'GEN ' || p_name as gnn60 from {part} where p_partkey % 11 <> 5",
    "strength": """
        select 'S60' || cast(n_nationkey as string) as str60, cast(n_nationkey as string) as strnum, 'MG' as strun50,
          cast(n_nationkey * 2 as string) as volnum, 'ML' as volun50 from {nation}""",
    "dose": "select 'DF' || cast(n_nationkey as string) as gcdf, 'DOSE ' || n_name as gcdf_desc, 'D' || n_name as dose from {nation} where n_nationkey < 11",
    "route": "select 'RT' || cast(n_nationkey as string) as gcrt, 'R' || n_name as rt, 'ROUTE ' || n_name as gcrt_desc from {nation} where n_nationkey < 7",
    "drug_cat": "select cast(r_regionkey as string) as dcc, 'CAT ' || r_name as dcc_desc from {region}",
    "atc_link": "select cast(p_partkey as string) as gcn_seqno, 'A' || cast(p_partkey % 30 as string) as atc from {part} where p_partkey % 25 <> 18",
    "atc_desc": "select 'A' || cast(n_nationkey as string) as atc, 'ATC ' || n_name as atc_desc from {nation}",
    "gtc": "select 'G' || cast(n_nationkey as string) as gtc, 'GTC ' || n_name as gtc_desc from {nation} where n_nationkey < 14",
    "tc": "select cast(n_nationkey as string) as tc, 'TC ' || n_name as tc_desc from {nation} where n_nationkey < 18",
    "hic3": "select 'H' || cast(n_nationkey as string) as hic3, 'HIC ' || n_name as hic3_desc from {nation} where n_nationkey < 22",
    "ahfs_link": """
        select cast(p_partkey as string) as gcn_seqno, cast(8000000 + p_partkey % 40 as string) as ahfs8, p_partkey % 2 as ahfs_rel from {part} where p_partkey % 30 <> 21
        union all select cast(p_partkey as string), '9999', 2 from {part} where p_partkey % 30 <> 21""",
    "ahfs_desc": """
        select cast(8000000 + n_nationkey as string) as ahfs8, 'AHFS ' || n_name as ahfs_desc from {nation}
        union all select '08000000', 'AHFS FAMILY' from {region} where r_regionkey = 0""",
    "etc_ndc": "select cast(p_partkey as string) as ndc, cast(p_partkey % 24 as string) as etc_id, p_partkey % 2 as etc_common_use_ind from {part}",
    "etc": "select cast(n_nationkey as string) as etc_id, 'ETC ' || n_name as etc_name from {nation} where n_nationkey < 20",
    "obc": """
        select 'B' || cast(r_regionkey as string) as obc, 1 as obc_sn, 'OB1 ' || r_name as obc_desc from {region}
        union all select 'B' || cast(r_regionkey as string), 2, 'OB2 ' || r_name from {region} where r_regionkey < 3""",
    "fda_link": """
        select cast(p_partkey as string) as ndc, cast(p_partkey % 2 as string) as nda_ind, cast(p_partkey % 3 as string) as anda_ind,
          cast(p_partkey * 11 as string) as listing_seq_no, 'TRADE ' || p_name as tradename from {part} where p_partkey % 4 <> 3""",
    "ndc_attribute": """
        select cast(l_partkey as string) as ndc, 19 as ndc_attribute_type_cd, '2019' || lpad(cast(l_suppkey % 12 + 1 as string), 2, '0') || '10' as ndc_attribute_value
        from {lineitem} where l_suppkey % 7 = 0
        union all select cast(p_partkey as string), 58, cast(p_partkey % 5 as string) from {part} where p_partkey % 3 = 0
        union all select cast(p_partkey as string), 59, case when p_partkey % 2 = 0 then '00000000' else '20200229' end from {part} where p_partkey % 6 < 4""",
    "ndc_attribute_desc": """
        select 58 as ndc_attribute_type_cd, cast(r_regionkey as string) as ndc_attribute_value, 'COD ' || r_name as ndc_attribute_value_dsc
        from {region} where r_regionkey < 4""",
    "rx_fills": """
        select user_id as member, case event_type when 'purchase' then '0169-7501-12' when 'click' then '0169-3935-11'
          when 'view' then '00002-8215-01' else 'OTHER' end as ndc, cast(ts as date) as fill_date, event_id
        from {events}""",
    "med_claims": f"""
        select o_custkey as member, case o_orderpriority when '1-URGENT' then 'E11.9' when '2-HIGH' then 'E08.1' when '3-MEDIUM' then 'E12.0'
          when '4-NOT SPECIFIED' then cast(null as string) else 'I10' end as dx_code, {shifted('o_orderdate')} as service_date
        from {{orders}}""",
    # JSON replies in several drifted shapes, one per event
    "review_json": """
        select event_id, case event_id % 6
          when 0 then '{{"is_valid": true, "issues": [], "summary": "' || event_type || '"}}'
          when 1 then '{{"overall_verdict": " Pass ", "review_summary": "' || event_type || '"}}'
          when 2 then '{{"is_valid": false, "issues": [{{"file": "m' || cast(user_id as string) || '.sql", "issue": "' || event_type || '", "severity": "ERROR"}}, 7, "note"]}}'
          when 3 then '{{"issues": ["' || event_type || '"]}}'
          when 4 then '["' || event_type || '"]'
          else '{{"overall_verdict": "fail", "issues": [{{"cell": "c' || cast(user_id as string) || '", "message": "' || event_type || '", "recommendation": "fix"}}]}}' end as reply
        from {events}""",
    "file_json": """
        select event_id, case event_id % 4
          when 0 then '{{"models": [{{"path": "models/m' || cast(user_id as string) || '.sql", "content": "select ' || cast(event_id as string) || '"}}, "junk"]}}'
          when 1 then '{{"models": [{{"path": "models/m' || cast(user_id as string) || '.sql"}}]}}'
          when 2 then '{{"models": "none"}}'
          else '{{"models": [{{"content": "x", "path": "macros/a' || cast(user_id as string) || '.sql"}}, {{"content": null, "path": "p"}}]}}' end as reply
        from {events}""",
    "analysis_json": """
        select event_id, case event_id % 3
          when 0 then '{{"source_tables": [{{"name": "T' || cast(user_id as string) || '", "schema": "raw", "columns_used": ["a", "b"]}}, "skip"], "macro_variables": [{{"name": "v", "value": ["x", "' || event_type || '"]}}]}}'
          when 1 then '{{"source_tables": [{{"table": " ", "table_name": "U' || cast(user_id as string) || '", "access_method": "view"}}], "transformation_blocks": [{{"output_table": ["o1", "o2"]}}, {{"block_id": ' || cast(event_id as string) || ', "output_table": null}}]}}'
          else '{{"source_tables": null, "transformation_blocks": [{{"name": "' || event_type || '", "type": "join", "output_table": "out"}}], "macro_variables": [{{"name": "n", "value": 5}}, {{"name": "z"}}]}}' end as reply
        from {events}""",
    "plan_json": """
        select event_id, case event_id % 3
          when 0 then '{{"models": [{{"name": "m' || cast(user_id as string) || '", "layer": "silver", "sources": ["s1", "' || event_type || '"], "logic": ["a", "b"]}}, "x", {{"model_name": "n", "logic": "' || event_type || '"}}]}}'
          when 1 then '{{"models": [5, {{"materialization": "view", "depends_on": ["m' || cast(user_id as string) || '"]}}], "notebook_cells": [{{"cell_type": "markdown", "source": "t' || cast(event_id as string) || '"}}, {{"cell_type": "sql", "source": "' || event_type || '"}}]}}'
          else '{{"notebook_cells": [{{"cell_type": "code"}}, {{"source": "u' || cast(user_id as string) || '"}}], "output_tables": [{{"name": "O' || cast(user_id as string) || '", "description": "' || event_type || '"}}], "intermediate_tables": [{{"schema_name": "work", "table_name": "W' || cast(event_id as string) || '"}}, 7]}}' end as reply
        from {events}""",
    "mapping": """
        select 'DW' as source_schema, upper(p_type) || '_' || replace(p_brand, '#', '_') as source_table, 'COL_' || cast(p_size as string) as source_column,
          'lake' as target_schema, 't_' || lower(replace(p_brand, '#', '_')) as target_table, 'c' || cast(p_partkey as string) as target_column, p_partkey as pos
        from {part}""",
    "column_refs": """
        select case p_partkey % 3 when 0 then 'dw' when 1 then 'Dw' else 'other' end as schema_name,
          case when p_partkey % 5 = 0 then p_type || 'S_' || replace(p_brand, '#', '') when p_partkey % 7 = 0 then 'tmp_' || cast(p_size as string)
            else p_type || '_' || replace(p_brand, '#', '_') end as table_name,
          case when p_partkey % 4 = 0 then 'column_' || cast(p_size as string) when p_partkey % 9 = 0 then 'zz' else 'col_' || cast(p_size as string) end as column_name
        from {part}""",
    # one corpus of three kinds: procedures, SAS programs, and models that refer to others
    "catalog_scripts": """
        select script, 'plsql' as kind, text from {scripts}
        union all select 'sas_' || script, 'sas', text from {sas_scripts}
        union all select 'm_' || cast(doc_id as string), 'model',
          'select * from ref(' || chr(39) || 'm_' || cast(doc_id * 2 as string) || chr(39) || ') join ref(' || chr(39) || 'x_' || source || chr(39) || ')'
          || chr(10) || text from {documents}""",
    # SAS programs: every document with two of the nineteen kinds of block, one of them long, and a comment
    "sas_scripts": """
        select cast(doc_id as string) as script,
          'proc sql; create table t as select 1;' || chr(10) || first_block || chr(10) || text || chr(10)
          || 'proc export data=' || lang || ' outfile=' || replace(text, ';', ' ') || '; run;' || chr(10)
          || second_block || chr(10) || chr(10) || chr(10) || chr(10) || '/* ' || source || chr(10) || text || ' */ quit;' as text
        from (select *,
          case doc_id % 19 when 0 then 'x ''ls -l'';' when 1 then 'x mkdir folder;' when 2 then 'data a; infile ''f.txt'' dlm='',''; input x; run;'
            when 3 then 'execute (insert into t select 1) by ora;' when 4 then 'proc append base=a data=b; run;' when 5 then 'proc delete data=a; run;'
            when 6 then 'proc datasets lib=work; quit;' when 7 then 'proc export data=a; run;' when 8 then 'ods excel file=''a'';' when 9 then 'ods
            _all_ close;' when 10 then 'ods listing close;' when 11 then 'ods html file=''b'';' when 12 then 'proc report data=a; column x; run;' when
            13 then 'proc odstext; p ''x''; run;' when 14 then 'proc template; define style s; run;' when 15 then 'filename m email to=''a'';' when 16
            then 'data _null_; file mymail; put ''x''; run;' when 17 then 'title1 ''a'';' when 18 then 'footnote ''b'';' end as first_block,
          case (doc_id * 7 + 3) % 19 when 0 then 'x ''ls -l'';' when 1 then 'x mkdir folder;' when 2 then 'data a; infile ''f.txt'' dlm='',''; input
            x; run;' when 3 then 'execute (insert into t select 1) by ora;' when 4 then 'proc append base=a data=b; run;' when 5 then 'proc delete
            data=a; run;' when 6 then 'proc datasets lib=work; quit;' when 7 then 'proc export data=a; run;' when 8 then 'ods excel file=''a'';' when 9
            then 'ods _all_ close;' when 10 then 'ods listing close;' when 11 then 'ods html file=''b'';' when 12 then 'proc report data=a; column x;
            run;' when 13 then 'proc odstext; p ''x''; run;' when 14 then 'proc template; define style s; run;' when 15 then 'filename m email
            to=''a'';' when 16 then 'data _null_; file mymail; put ''x''; run;' when 17 then 'title1 ''a'';' when 18 then 'footnote ''b'';' end as second_block
          from {documents})""",
    # scripts: every document becomes the body of a legacy script
    "scripts": """
        select cast(doc_id as string) as script,
          'set define off;' || chr(10) || '  SET  serveroutput ON ;' || chr(10)
          || 'create or replace procedure p_' || cast(doc_id as string) || ' as begin' || chr(10)
          || 'insert into stage.t_' || cast(doc_id % 50 as string) || ' select nvl(a.x, 0), decode(a.y, 1, 2) from raw.' || source
          || ' a join ref.' || lang || ' b on a.k = b.k;' || chr(10)
          || 'update stage.u_' || cast(doc_id % 7 as string) || ' set v = col::int;' || chr(10)
          || 'delete from "STAGE"."T_' || cast(doc_id % 11 as string) || '" where exists (select 1 from dual);' || chr(10)
          || text || chr(10) || chr(10) || chr(10) || chr(10) || '/' || chr(10) || 'show errors;' || chr(10) as text
        from {documents}""",
}


# The join below the lines and its order in Spark, which runs joins as they are nested: the orders meet their members first, and
# lines meet orders by the claim id. So the lines move once and then lie by claim, in place of once for each table and once by claim.
# The rows are the same, and the checking SQL keeps the join as written above.
LINE_JOIN = "{lineitem} join {orders} on l_orderkey = o_orderkey join {who} on o_custkey = ck"
LINE_JOIN_BY_CLAIM = "{lineitem} join ({orders} join {who} on o_custkey = ck) on cast(l_orderkey as string) = cast(o_orderkey as string)"


def _refs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Domain:
    """Lazily built domain tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                sql = TABLES[name].replace(LINE_JOIN, LINE_JOIN_BY_CLAIM)
                self._made[name] = self.spark.sql(sql, **{r: self.table(r) for r in _refs(sql)})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]


def oracle(sql: str, **more: str) -> str:
    """Prefix checking SQL with the domain tables it names as ``{name}``."""
    pool = {**TABLES, **more}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for ref in _refs(text):
            if ref in pool and ref not in ordered:
                visit(pool[ref])
                ordered.append(ref)

    visit(sql)

    def sub(text: str) -> str:
        def name(m: re.Match) -> str:
            ref = m.group(1)
            return f"d_{ref}" if ref in pool else ref if ref in BASE_TABLES else m.group(0)

        return re.sub(r"\{(\w+)\}", name, text).replace("{{", "{").replace("}}", "}")

    ctes = [f"d_{n} as ({sub(pool[n])})" for n in ordered]
    body = sub(sql)
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body
