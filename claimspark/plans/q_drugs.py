"""Drug master queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimspark.functions.dates import parse_yyyymmdd
from claimspark.jobs import drug_master
from claimspark.operators.reshape import latest_n_wide, spread
from claimspark.plans.q_visits import _tables
from claimspark.plans.registry import query

AS_OF = "2024-01-20"
RANKS = range(1, 9)
DAY = "try_strptime(nullif({}, '00000000'), '%Y%m%d')::date::varchar"


def _latest_sql(kind: str, prefix: str, label: bool = False) -> str:
    tie = "npt_pricex, npt_type" if label else "npt_pricex"
    parts = []
    for i in RANKS:
        parts.append(f"cast(max(npt_pricex) filter (where rn = {i}) as double) as {prefix}_unit_price{i}")
        parts.append(f"max({DAY.format('npt_datec')}) filter (where rn = {i}) as {prefix}_effective_date{i}")
        if label:
            parts.append(f"max(if(npt_type = '24', 'Brand', 'Generic')) filter (where rn = {i}) as {prefix}_type{i}")
    return f"""select ndc, {', '.join(parts)} from (select *, row_number() over (partition by ndc
        order by npt_datec desc nulls first, {tie} nulls last) as rn from {{ndc_price}} where npt_type in ({kind})) where rn <= 8 group by ndc"""


L_PRICES = {"wac": _latest_sql("'09'", "wac"), "ful": _latest_sql("'23'", "ful"), "nadac": _latest_sql("'24', '25'", "nadac", True)}


@query("latest_n_wide", "select * from {wac}", wac=L_PRICES["wac"])
def latest_n(dom):
    prices = dom.ndc_price.withColumn("day", parse_yyyymmdd(F.col("npt_datec")))
    order = [F.col("npt_datec").desc_nulls_first(), F.col("npt_pricex").asc_nulls_last()]
    cols = {"npt_pricex": "wac_unit_price{}", "day": "wac_effective_date{}"}
    return latest_n_wide(prices, ["ndc"], order, cols, 8, F.col("npt_type") == "09")


@query("price_columns", "select * from {wac} full join {nadac} using (ndc) full join {ful} using (ndc)", **L_PRICES)
def price_columns(dom):
    return drug_master.price_columns(dom.ndc_price)


@query(
    "nadac_prices",
    """select ndc, npt_type, cast(npt_pricex as double) as npt_pricex, npt_datec, row_a, row_b,
       case npt_type when '24' then 'Brand' else 'Generic' end as nadac_type from {ndc_price} where npt_type in ('24', '25')""",
)
def nadac_prices(dom):
    return drug_master.nadac_prices(dom.ndc_price)


@query(
    "attr_rank",
    """select ndc, max(v) filter (where rn = 1) as first_date, max(v) filter (where rn = 2) as second_date from (
         select ndc, ndc_attribute_value as v, row_number() over (partition by ndc order by ndc_attribute_value nulls last) as rn
         from {ndc_attribute} where ndc_attribute_type_cd = 19) group by ndc""",
)
def attr_rank(dom):
    ranked = drug_master.attr_rank(dom.ndc_attribute)
    out = spread(ranked, ["ndc"], F.col("rn"), (1, 2), {"ndc_attribute_value": "d{}"})
    return out.select("ndc", F.col("d1").alias("first_date"), F.col("d2").alias("second_date"))


CASCADE = """case when gni = '0' then {0} when gni = '1' then {1} when gni = '2' and innov = '1' then {2} when nda_ind = '1' then {3}
   when anda_ind = '1' then {4} when innov = '0' and repack = '0' then {5} when innov = '0' and repack = '1' then {6} else ' ' end"""
IND = CASCADE.format("'0'", "'1'", "'2'", "'2'", "'1'", "'1'", "'2'")
RULE = CASCADE.format(*[f"'{i}'" for i in range(1, 8)])


@query(
    "rule_cascade",
    f"select ndc, {IND} as derived_generic_pricing_ind, {RULE} as derived_gpi_rule from {{ndc_master}} left join {{fda_link}} using (ndc)",
)
def rule_cascade(dom):
    value, rule = drug_master.derived_generic()
    df = dom.ndc_master.join(dom.fda_link.hint("merge"), "ndc", "left")
    return df.select("ndc", value.alias("derived_generic_pricing_ind"), rule.alias("derived_gpi_rule"))


def _case(col: str, labels: dict[str, str], default: str) -> str:
    return f"case {col} " + " ".join(f"when '{k}' then '{v}'" for k, v in labels.items()) + f" else '{default}' end"


D = drug_master
MASTER = f"""
  select n.ndc, lpad(mid.medid, 8, '0') as medid, m2.med_medid_desc, m2.med_strength_uom,
    lpad(m2.routed_dosage_form_med_id, 8, '0') as routed_dosage_form_med_id, rdf.med_routed_df_med_id_desc as routed_dosage_form_medid_desc,
    lpad(rdf.routed_med_id, 8, '0') as routed_med_id, rm.med_routed_med_id_desc, lpad(m2.generic_medid, 8, '0') as generic_medid,
    lpad(rg.routed_gen_id, 8, '0') as routed_gen_id, rgd.routed_gen_desc,
    {DAY.format('n.daddnc')} as date_ndc_added, {DAY.format('n.dupdc')} as date_ndc_updated, {DAY.format('n.obsdtec')} as date_ndc_obsolete,
    n.ln as label_name, n.ln60 as label_name60, n.bn as brand_name, gen.gnn60 as generic_name, lpad(g.gcn, 5, '0') as gcn,
    lpad(gm.tc, 2, '0') as standard_tc_code, tc.tc_desc as standard_tc_desc, gm.hic3 as specific_tc_code, hic.hic3_desc as specific_tc_desc,
    lpad(n.gcn_seqno, 6, '0') as clinical_formulation_id, lpad(gm.hicl_seqno, 6, '0') as hicl_seqno,
    substr(lpad(ah.ahfs8, 8, '0'), 1, 6) as ahfs6, a6.ahfs_desc as ahfs6_desc, lpad(ah.ahfs8, 8, '0') as ahfs, a8.ahfs_desc,
    coalesce(al.atc, '') as atc, coalesce(ad.atc_desc, '') as atc_desc, gm.gtc as generic_tx_class_code, gtc.gtc_desc as generic_tx_class_desc,
    n.cl as drug_class, {_case('n.cl', D.DRUG_CLASS, ' ')} as drug_class_desc, lpad(en.etc_id, 8, '0') as etc_id, et.etc_name,
    n.lblrid as labeler_id, lb.mfg as manufacturer, lb.lblrind as labeler_ind, n.df as drug_form_code, {_case('n.df', D.DRUG_FORM, '')} as drug_form_desc,
    gm.gcdf as dose_form_code, ds.gcdf_desc as dose_form_desc, ds.dose, gm.gcrt as route_code, rt.rt as route, rt.gcrt_desc as route_desc,
    gm.str as drug_strength_desc, gm.str60 as drug_strength_desc60, st.strnum as strength_number, st.strun50 as strength_unit,
    st.volnum as volume_number, st.volun50 as volume_unit, n.ps as package_size, gm.dcc as drug_category_code, dc.dcc_desc as drug_category_desc,
    n.dea as dea_code, {_case('n.dea', D.DEA, '')} as dea_desc, n.obc as orange_book_code, o1.obc_desc as orange_book_desc, o2.obc_desc as orange_book_desc2,
    c58.ndc_attribute_value as cod_status_code, c58d.ndc_attribute_value_dsc as cod_status_desc,
    {DAY.format('c59.ndc_attribute_value')} as cod_status_effective_date, n.maint as maintenance_drug_ind,
    {_case('n.maint', D.MAINTENANCE, 'Not a maintenance drug')} as maintenance_drug_desc, n.ndcgi1 as ss_ms_ind, {_case('n.ndcgi1', D.SOURCES, '')} as ss_ms_desc,
    n.gpi as generic_pricing_ind, n.gti as therapeutic_equivalence_ind, {_case('n.gti', D.EQUIVALENCE, ' ')} as therapeutic_equivalence_desc,
    {IND} as derived_generic_pricing_ind, {RULE} as derived_gpi_rule, {_case('(' + IND + ')', D.DERIVED_GENERIC, '')} as derived_generic_pricing_desc,
    n.gni as generic_name_ind, {_case('n.gni', D.GENERIC_NAME, '')} as generic_name_desc, n.stpk as standard_package_ind,
    {_case('n.stpk', D.STANDARD_PACKAGE, '')} as standard_package_desc, n.shlf_pck as shelf_pack, n.pd as package_desc, n.uu as unit_use_ind,
    {_case('n.uu', D.UNIT_USE, '')} as unit_use_desc, n.ud as unit_dose_ind, {_case('n.ud', D.UNIT_DOSE, '')} as unit_dose_desc,
    n.innov as innovator_ind, {_case('n.innov', D.INNOVATOR, '')} as innovator_desc, n.repack as repackager_ind, {_case('n.repack', D.REPACKAGER, '')} as repackager_desc,
    fda.nda_ind, {_case('fda.nda_ind', D.NDA, '')} as nda_desc, fda.anda_ind, {_case('fda.anda_ind', D.ANDA, '')} as anda_desc,
    fda.listing_seq_no, fda.tradename, {DAY.format('bla.d1')} as bla_date, {DAY.format('bla.d2')} as bla_date2,
    wac.* exclude (ndc), nadac.* exclude (ndc), ful.* exclude (ndc), '{AS_OF}' as load_date
  from {{ndc_master}} n left join {{ndc_medid}} mid on n.ndc = mid.ndc left join {{med}} m2 on mid.medid = m2.medid
  left join {{routed_gen_ndc}} rg on n.ndc = rg.ndc left join {{routed_df_med}} rdf on m2.routed_dosage_form_med_id = rdf.routed_dosage_form_med_id
  left join {{routed_med}} rm on rdf.routed_med_id = rm.routed_med_id left join {{routed_gen}} rgd on rg.routed_gen_id = rgd.routed_gen_id
  left join {{labeler}} lb on n.lblrid = lb.lblrid left join {{gcn_link}} g on n.gcn_seqno = g.gcn_seqno
  left join {{gcn_master}} gm on n.gcn_seqno = gm.gcn_seqno left join {{atc_link}} al on n.gcn_seqno = al.gcn_seqno
  left join {{atc_desc}} ad on al.atc = ad.atc left join {{hicl}} gen on gm.hicl_seqno = gen.hicl_seqno left join {{gtc}} gtc on gm.gtc = gtc.gtc
  left join {{strength}} st on gm.str60 = st.str60 left join {{dose}} ds on gm.gcdf = ds.gcdf left join {{route}} rt on gm.gcrt = rt.gcrt
  left join {{drug_cat}} dc on gm.dcc = dc.dcc left join {{obc}} o1 on n.obc = o1.obc and o1.obc_sn = 1 left join {{obc}} o2 on n.obc = o2.obc and o2.obc_sn = 2
  left join {{fda_link}} fda on n.ndc = fda.ndc left join {{tc}} tc on gm.tc = tc.tc left join {{hic3}} hic on gm.hic3 = hic.hic3
  left join {{ahfs_link}} ah on n.gcn_seqno = ah.gcn_seqno and ah.ahfs_rel = 1 left join {{ahfs_desc}} a8 on ah.ahfs8 = a8.ahfs8
  left join {{ahfs_desc}} a6 on substr(lpad(ah.ahfs8, 8, '0'), 1, 6) || '00' = a6.ahfs8
  left join {{etc_ndc}} en on n.ndc = en.ndc and en.etc_common_use_ind = 1 left join {{etc}} et on en.etc_id = et.etc_id
  left join (select ndc, max(v) filter (where rn = 1) as d1, max(v) filter (where rn = 2) as d2 from (select ndc, ndc_attribute_value as v,
      row_number() over (partition by ndc order by ndc_attribute_value) as rn from {{ndc_attribute}} where ndc_attribute_type_cd = 19) group by ndc) bla on n.ndc = bla.ndc
  left join (select * from {{ndc_attribute}} where ndc_attribute_type_cd = 58) c58 on n.ndc = c58.ndc
  left join {{ndc_attribute_desc}} c58d on c58d.ndc_attribute_type_cd = 58 and c58.ndc_attribute_value = c58d.ndc_attribute_value
  left join (select * from {{ndc_attribute}} where ndc_attribute_type_cd = 59) c59 on n.ndc = c59.ndc
  left join {{wac}} wac on n.ndc = wac.ndc left join {{nadac}} nadac on n.ndc = nadac.ndc left join {{ful}} ful on n.ndc = ful.ndc"""


@query("drug_master", MASTER, **L_PRICES)
def drug_master_query(dom):
    return drug_master.drug_master(_tables(dom), AS_OF)


@query("filtered_dim_join", """
    select n.ndc, o1.obc_desc as first_desc, o2.obc_desc as second_desc from {ndc_master} n
    left join {obc} o1 on n.obc = o1.obc and o1.obc_sn = 1 left join {obc} o2 on n.obc = o2.obc and o2.obc_sn = 2""")
def filtered_dim_join(dom):
    df = drug_master._join(dom.ndc_master, dom.obc, "obc", {"obc_desc": "first_desc"}, where=F.col("obc_sn") == 1)
    df = drug_master._join(df, dom.obc, "obc", {"obc_desc": "second_desc"}, where=F.col("obc_sn") == 2)
    return df.select("ndc", "first_desc", "second_desc")
