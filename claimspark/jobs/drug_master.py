"""Drug master: one wide row per NDC with names, classes, attributes and recent prices.

Joined in stages of a few reference tables each; the 24 price joins of the legacy job are three
ranked and spread price families.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions.compat import lpad_code
from claimspark.functions.dates import parse_yyyymmdd, stamp_load
from claimspark.operators.project import describe, rule_cascade
from claimspark.operators.ranking import top_n
from claimspark.operators.reshape import latest_n_wide, spread

N_PRICES = 8

# --- fixed values: price types, attribute types and code descriptions ---------
WAC, FUL, NADAC_BRAND, NADAC_GENERIC = "09", "23", "24", "25"
BLA_TYPE, COD_TYPE, COD_DATE_TYPE = 19, 58, 59
DRUG_CLASS = {
    "F": "Product labeling indicates prescription or physician supervision required for use.",
    "O": "Product has no labeling indicating dispensing limitations.",
}
DRUG_FORM = {"1": "each (tablets, kits, etc.)", "2": "milliliters (liquids)", "3": "grams (solids)"}
DEA = {
    "0": "No control",
    "1": "LSD, Heroin, Marijuana - Research only",
    "2": "Morphine, Meperidine, Amphetamines, etc., most potential for abuse",
    "3": "Aspirin/Codeine, etc., less abused",
    "4": "Diazepam, etc., potential abuse",
    "5": "Controlled sale by pharmacy only",
}
MAINTENANCE = {"1": "Maintenance drug"}
SOURCES = {"1": "Multiple source", "2": "Single source"}
EQUIVALENCE = {
    "0": "Non-drug item, such as medical supplies and bulk chemicals",
    "1": "Orange Book B-rated drug product",
    "2": "Single source",
    "3": "Orange Book A-rated drug product",
    "4": "Product not listed in the Orange Book",
}
DERIVED_GENERIC = {"0": "Supplies/Non-drug items", "1": "Generic", "2": "Brand"}
GENERIC_NAME = {
    "0": "Non-drug item, such as medical supplies and bulk chemicals",
    "1": "Generically named",
    "2": "Brand named",
}
STANDARD_PACKAGE = {"0": "All Other Package Sizes", "1": "Standard package"}
UNIT_USE = {"0": "All Other Products", "1": "Unit of Use"}
UNIT_DOSE = {"0": "All Other Products", "1": "Unit Dose"}
INNOVATOR = {"0": "Default non-innovator drug", "1": "Innovator"}
REPACKAGER = {"0": "Not repackager", "1": "Repackager"}
NDA = {"0": "Not approved under an NDA.", "1": "Approved under an NDA."}
ANDA = {"0": "Not approved under an ANDA.", "1": "Approved under an ANDA."}
# -----------------------------------------------------------------------------


def nadac_prices(prices: DataFrame) -> DataFrame:
    """Brand and generic NADAC prices with their label."""
    label = F.when(F.col("npt_type") == NADAC_BRAND, "Brand").when(F.col("npt_type") == NADAC_GENERIC, "Generic")
    return prices.where(F.col("npt_type").isin(NADAC_BRAND, NADAC_GENERIC)).withColumn("nadac_type", label)


def derived_generic() -> tuple[Column, Column]:
    """Derived generic indicator and the number of the rule that set it; a blank when none fires."""
    c = F.col
    rules = [
        (c("gni") == "0", "0"),
        (c("gni") == "1", "1"),
        ((c("gni") == "2") & (c("innov") == "1"), "2"),
        (c("nda_ind") == "1", "2"),
        (c("anda_ind") == "1", "1"),
        ((c("innov") == "0") & (c("repack") == "0"), "1"),
        ((c("innov") == "0") & (c("repack") == "1"), "2"),
    ]
    return rule_cascade(rules, " ")


def _latest(prices: DataFrame, cols: Mapping[str, str], ties: Sequence[str]) -> DataFrame:
    order = [F.col("npt_datec").desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties]]
    return latest_n_wide(prices.withColumn("_day", parse_yyyymmdd(F.col("npt_datec"))), ["ndc"], order, cols, N_PRICES)


def price_columns(prices: DataFrame) -> DataFrame:
    """The eight latest WAC, NADAC and FUL prices per NDC, as one row. Ties on the date go to the lower price."""
    wac = _latest(prices.where(F.col("npt_type") == WAC), {"npt_pricex": "wac_unit_price{}", "_day": "wac_effective_date{}"}, ["npt_pricex"])
    nadac = _latest(
        nadac_prices(prices),
        {"npt_pricex": "nadac_unit_price{}", "nadac_type": "nadac_type{}", "_day": "nadac_effective_date{}"},
        ["npt_pricex", "npt_type"],
    )
    ful = _latest(prices.where(F.col("npt_type") == FUL), {"npt_pricex": "ful_unit_price{}", "_day": "ful_effective_date{}"}, ["npt_pricex"])
    return wac.join(nadac.hint("merge"), "ndc", "full").join(ful.hint("merge"), "ndc", "full")


def attr_rank(attributes: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` license dates per NDC, by value text."""
    dates = attributes.where(F.col("ndc_attribute_type_cd") == BLA_TYPE)
    return top_n(dates, ["ndc"], [F.col("ndc_attribute_value").asc_nulls_last()], n)


def _join(
    df: DataFrame, dim: DataFrame, key: str, cols: Mapping[str, str], left: Column | None = None, where: Column | None = None, grows: bool = False
) -> DataFrame:
    """Left join a reference table filtered beforehand, under its output names.

    A table that ``grows`` with the drugs is shuffled, whatever its files' size: compressed, it seems small enough to broadcast,
    and a dozen such tables would be built in the driver at once.
    """
    rows = dim if where is None else dim.where(where)
    rows = rows.select(F.col(key).alias("_key"), *[F.col(c).alias(out) for c, out in cols.items()])
    rows = rows.hint("merge") if grows else rows
    return df.join(rows, (F.col(key) if left is None else left) == F.col("_key"), "left").drop("_key")


def _med_names(t: Mapping[str, DataFrame]) -> DataFrame:
    """The names along the chain of medication ids, per NDC; narrow rows, so that the master is not shuffled for each link."""
    df = t["ndc_medid"].select("ndc", "medid")
    med = {"med_medid_desc": "med_medid_desc", "med_strength_uom": "med_strength_uom", "routed_dosage_form_med_id": "_rdf", "generic_medid": "_generic_medid"}
    df = _join(df, t["med"], "medid", med, grows=True)
    rdf = {"med_routed_df_med_id_desc": "routed_dosage_form_medid_desc", "routed_med_id": "_routed_med"}
    df = _join(df, t["routed_df_med"], "routed_dosage_form_med_id", rdf, F.col("_rdf"), grows=True)
    return _join(df, t["routed_med"], "routed_med_id", {"med_routed_med_id_desc": "med_routed_med_id_desc"}, F.col("_routed_med"), grows=True)


def product_names(df: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Names by NDC."""
    names = _med_names(t)
    df = _join(df, names, "ndc", {c: c for c in names.columns if c != "ndc"}, grows=True)
    routed = t["routed_gen_ndc"].select("ndc", F.col("routed_gen_id").alias("_routed_gen"))
    routed = _join(routed, t["routed_gen"], "routed_gen_id", {"routed_gen_desc": "routed_gen_desc"}, F.col("_routed_gen"), grows=True)
    df = _join(df, routed, "ndc", {"_routed_gen": "_routed_gen", "routed_gen_desc": "routed_gen_desc"}, grows=True)
    return _join(df, t["labeler"], "lblrid", {"mfg": "manufacturer", "lblrind": "labeler_ind"})


def formulation(df: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """What the clinical formulation, by ``gcn_seqno``, says of strength, dose and route."""
    df = _join(df, t["gcn_link"], "gcn_seqno", {"gcn": "_gcn"}, grows=True)
    master = {c: f"_{c}" for c in ("tc", "hic3", "hicl_seqno", "gtc", "gcdf", "gcrt", "str", "str60", "dcc")}
    named = t["gcn_master"].select("gcn_seqno", *[F.col(c).alias(out) for c, out in master.items()])
    named = _join(named, t["hicl"], "hicl_seqno", {"gnn60": "generic_name"}, F.col("_hicl_seqno"), grows=True)
    df = _join(df, named, "gcn_seqno", {c: c for c in named.columns if c != "gcn_seqno"}, grows=True)
    df = _join(df, t["strength"], "str60", {"strnum": "strength_number", "strun50": "strength_unit", "volnum": "volume_number", "volun50": "volume_unit"}, F.col("_str60"))
    df = _join(df, t["dose"], "gcdf", {"gcdf_desc": "dose_form_desc", "dose": "dose"}, F.col("_gcdf"))
    df = _join(df, t["route"], "gcrt", {"rt": "route", "gcrt_desc": "route_desc"}, F.col("_gcrt"))
    return _join(df, t["drug_cat"], "dcc", {"dcc_desc": "drug_category_desc"}, F.col("_dcc"))


def classes(df: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Therapeutic classes of the clinical formulation; ``formulation`` comes before."""
    df = _join(df, t["atc_link"], "gcn_seqno", {"atc": "_atc"}, grows=True)
    df = _join(df, t["atc_desc"], "atc", {"atc_desc": "_atc_desc"}, F.col("_atc"))
    df = _join(df, t["gtc"], "gtc", {"gtc_desc": "generic_tx_class_desc"}, F.col("_gtc"))
    df = _join(df, t["tc"], "tc", {"tc_desc": "standard_tc_desc"}, F.col("_tc"))
    df = _join(df, t["hic3"], "hic3", {"hic3_desc": "specific_tc_desc"}, F.col("_hic3"))
    df = _join(df, t["ahfs_link"], "gcn_seqno", {"ahfs8": "_ahfs8"}, where=F.col("ahfs_rel") == 1, grows=True)
    df = _join(df, t["ahfs_desc"], "ahfs8", {"ahfs_desc": "ahfs_desc"}, F.col("_ahfs8"))
    family = F.concat(F.substring(lpad_code(F.col("_ahfs8"), 8), 1, 6), F.lit("00"))
    return _join(df, t["ahfs_desc"], "ahfs8", {"ahfs_desc": "ahfs6_desc"}, family)


def attributes(df: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Classes, approvals, status and license dates by NDC."""
    df = _join(df, t["etc_ndc"], "ndc", {"etc_id": "_etc"}, where=F.col("etc_common_use_ind") == 1, grows=True)
    df = _join(df, t["etc"], "etc_id", {"etc_name": "etc_name"}, F.col("_etc"))
    df = _join(df, t["obc"], "obc", {"obc_desc": "orange_book_desc"}, where=F.col("obc_sn") == 1)
    df = _join(df, t["obc"], "obc", {"obc_desc": "orange_book_desc2"}, where=F.col("obc_sn") == 2)
    df = _join(df, t["fda_link"], "ndc", {c: c for c in ("nda_ind", "anda_ind", "listing_seq_no", "tradename")}, grows=True)
    bla = spread(attr_rank(t["ndc_attribute"]), ["ndc"], F.col("rn"), (1, 2), {"ndc_attribute_value": "_bla{}"})
    df = _join(df, bla, "ndc", {"_bla1": "_bla1", "_bla2": "_bla2"}, grows=True)
    kind = F.col("ndc_attribute_type_cd")
    df = _join(df, t["ndc_attribute"], "ndc", {"ndc_attribute_value": "cod_status_code"}, where=kind == COD_TYPE, grows=True)
    df = _join(df, t["ndc_attribute_desc"], "ndc_attribute_value", {"ndc_attribute_value_dsc": "cod_status_desc"}, F.col("cod_status_code"), kind == COD_TYPE)
    return _join(df, t["ndc_attribute"], "ndc", {"ndc_attribute_value": "_cod_date"}, where=kind == COD_DATE_TYPE, grows=True)


def drug_master(t: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> DataFrame:
    """The wide drug table over the 29 reference tables in ``t``, stamped with the load date.

    What is found by NDC comes first and what is found by formulation last, so the wide rows are shuffled once for each.
    """
    df = attributes(product_names(t["ndc_master"], t), t)
    prices = price_columns(t["ndc_price"])
    df = df.join(prices.hint("merge"), "ndc", "left")
    df = classes(formulation(df, t), t)
    indicator, rule = derived_generic()
    df = df.withColumns({"derived_generic_pricing_ind": indicator, "derived_gpi_rule": rule})
    c = F.col
    # --- fixed values: the target's column names, in target order ---------------
    out: dict[str, Column] = {
        "ndc": c("ndc"),
        "medid": lpad_code(c("medid"), 8),
        "med_medid_desc": c("med_medid_desc"),
        "med_strength_uom": c("med_strength_uom"),
        "routed_dosage_form_med_id": lpad_code(c("_rdf"), 8),
        "routed_dosage_form_medid_desc": c("routed_dosage_form_medid_desc"),
        "routed_med_id": lpad_code(c("_routed_med"), 8),
        "med_routed_med_id_desc": c("med_routed_med_id_desc"),
        "generic_medid": lpad_code(c("_generic_medid"), 8),
        "routed_gen_id": lpad_code(c("_routed_gen"), 8),
        "routed_gen_desc": c("routed_gen_desc"),
        "date_ndc_added": parse_yyyymmdd(c("daddnc")),
        "date_ndc_updated": parse_yyyymmdd(c("dupdc")),
        "date_ndc_obsolete": parse_yyyymmdd(c("obsdtec")),
        "label_name": c("ln"),
        "label_name60": c("ln60"),
        "brand_name": c("bn"),
        "generic_name": c("generic_name"),
        "gcn": lpad_code(c("_gcn"), 5),
        "standard_tc_code": lpad_code(c("_tc"), 2),
        "standard_tc_desc": c("standard_tc_desc"),
        "specific_tc_code": c("_hic3"),
        "specific_tc_desc": c("specific_tc_desc"),
        "clinical_formulation_id": lpad_code(c("gcn_seqno"), 6),
        "hicl_seqno": lpad_code(c("_hicl_seqno"), 6),
        "ahfs6": F.substring(lpad_code(c("_ahfs8"), 8), 1, 6),
        "ahfs6_desc": c("ahfs6_desc"),
        "ahfs": lpad_code(c("_ahfs8"), 8),
        "ahfs_desc": c("ahfs_desc"),
        "atc": F.coalesce("_atc", F.lit("")),
        "atc_desc": F.coalesce("_atc_desc", F.lit("")),
        "generic_tx_class_code": c("_gtc"),
        "generic_tx_class_desc": c("generic_tx_class_desc"),
        "drug_class": c("cl"),
        "drug_class_desc": describe(c("cl"), DRUG_CLASS, " "),
        "etc_id": lpad_code(c("_etc"), 8),
        "etc_name": c("etc_name"),
        "labeler_id": c("lblrid"),
        "manufacturer": c("manufacturer"),
        "labeler_ind": c("labeler_ind"),
        "drug_form_code": c("df"),
        "drug_form_desc": describe(c("df"), DRUG_FORM, ""),
        "dose_form_code": c("_gcdf"),
        "dose_form_desc": c("dose_form_desc"),
        "dose": c("dose"),
        "route_code": c("_gcrt"),
        "route": c("route"),
        "route_desc": c("route_desc"),
        "drug_strength_desc": c("_str"),
        "drug_strength_desc60": c("_str60"),
        **{n: c(n) for n in ("strength_number", "strength_unit", "volume_number", "volume_unit")},
        "package_size": c("ps"),
        "drug_category_code": c("_dcc"),
        "drug_category_desc": c("drug_category_desc"),
        "dea_code": c("dea"),
        "dea_desc": describe(c("dea"), DEA, ""),
        "orange_book_code": c("obc"),
        "orange_book_desc": c("orange_book_desc"),
        "orange_book_desc2": c("orange_book_desc2"),
        "cod_status_code": c("cod_status_code"),
        "cod_status_desc": c("cod_status_desc"),
        "cod_status_effective_date": parse_yyyymmdd(c("_cod_date")),
        "maintenance_drug_ind": c("maint"),
        "maintenance_drug_desc": describe(c("maint"), MAINTENANCE, "Not a maintenance drug"),
        "ss_ms_ind": c("ndcgi1"),
        "ss_ms_desc": describe(c("ndcgi1"), SOURCES, ""),
        "generic_pricing_ind": c("gpi"),
        "therapeutic_equivalence_ind": c("gti"),
        "therapeutic_equivalence_desc": describe(c("gti"), EQUIVALENCE, " "),
        "derived_generic_pricing_ind": c("derived_generic_pricing_ind"),
        "derived_gpi_rule": c("derived_gpi_rule"),
        "derived_generic_pricing_desc": describe(c("derived_generic_pricing_ind"), DERIVED_GENERIC, ""),
        "generic_name_ind": c("gni"),
        "generic_name_desc": describe(c("gni"), GENERIC_NAME, ""),
        "standard_package_ind": c("stpk"),
        "standard_package_desc": describe(c("stpk"), STANDARD_PACKAGE, ""),
        "shelf_pack": c("shlf_pck"),
        "package_desc": c("pd"),
        "unit_use_ind": c("uu"),
        "unit_use_desc": describe(c("uu"), UNIT_USE, ""),
        "unit_dose_ind": c("ud"),
        "unit_dose_desc": describe(c("ud"), UNIT_DOSE, ""),
        "innovator_ind": c("innov"),
        "innovator_desc": describe(c("innov"), INNOVATOR, ""),
        "repackager_ind": c("repack"),
        "repackager_desc": describe(c("repack"), REPACKAGER, ""),
        "nda_ind": c("nda_ind"),
        "nda_desc": describe(c("nda_ind"), NDA, ""),
        "anda_ind": c("anda_ind"),
        "anda_desc": describe(c("anda_ind"), ANDA, ""),
        "listing_seq_no": c("listing_seq_no"),
        "tradename": c("tradename"),
        "bla_date": parse_yyyymmdd(c("_bla1")),
        "bla_date2": parse_yyyymmdd(c("_bla2")),
        **{n: c(n) for n in prices.columns if n != "ndc"},
    }
    # -----------------------------------------------------------------------------
    return stamp_load(df.select(*[expr.alias(name) for name, expr in out.items()]), as_of, "load_date")
