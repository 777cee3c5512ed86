"""Claims extract: one wide row per service line (times ICD version, product and group).

Lines, headers and codes are kept in buckets of the claim key, so they rank, group and join where they lie. Everything that a
claim's lines have in common is put together once a claim: its variants, one for each ICD version, product and group. A line
meets the variants of its claim, and its sequence number follows from the claim's start, its rank and the variant's number, so
that only a row for each claim is sorted over the payer and LOB and the wide rows are never shuffled. Codes by slot are maps until
the last step, and a claim meets its codes after its look-ups by member and provider, so that these move narrow rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.functions import codes
from claimspark.functions.compat import keep_if_len, lpad_code, pad_if, typed_null
from claimspark.functions.dates import as_date, los_days
from claimspark.operators.joins import spread_nulls
from claimspark.operators.project import stack
from claimspark.operators.ranking import rank_rows, running_starts
from claimspark.operators.reshape import dx_slots, primary_taxonomy, px_slots
from claimspark.session import bucketed, stored

MEMBER_KEY = ["payer", "lob", "member_id"]
CLAIM_KEY = [*MEMBER_KEY, "claim_id"]
# The same keys for sorts, joins and buckets: Spark sorts by the first bytes of the first column, which tell claims apart.
MEMBER_SORT = MEMBER_KEY[::-1]
CLAIM_SORT = CLAIM_KEY[::-1]
SLOTS = 30

# --- fixed values -----------------------------------------------------------
LIST_A_PAYERS = (
    "MSSP", "MSSP TRACK ONE PLUS", "MSSP NYMP", "BRIGHT", "HUMANA", "CIGNA", "1199", "UHH", "UMR", "OSCAR", "REACH",
)
Y_FAMILY_PAYER = "HNACO"
LINE_ORDER = (
    "service_code", "cpt_modifier1", "cpt_modifier2", "allowed_amount", "paid_amount", "unit_count", "place_of_service",
    "cap_claim_ind",
)
# -----------------------------------------------------------------------------

# Tables with one or more rows for each claim.
CLAIM_FACTS = ("fact_service", "claim_header", "fact_dxpx")
# Tables filtered by payer and LOB; the crosswalks are shared by both families.
FAMILY_TABLES = ("fact_service", "claim_header", "member", "fact_dxpx", "fact_member")


def line_order(lines: DataFrame) -> list[Column]:
    """Nine ranking keys, highest first and NULLs last, then every other column so ties are settled."""
    first = F.lpad(F.col("revenue_code"), 4, "0").desc_nulls_last()
    rest = [c for c in lines.columns if c not in (*CLAIM_KEY, *LINE_ORDER)]
    return [first, *[F.col(c).desc_nulls_last() for c in LINE_ORDER], *[F.col(c).desc_nulls_last() for c in rest]]


def rank_claim_lines(lines: DataFrame) -> DataFrame:
    """Rank of each line in its claim; the placeholder member is left out."""
    kept = lines.where(F.col("member_id") != codes.SENTINEL_MEMBER)
    return rank_rows(kept, CLAIM_SORT, line_order(lines), "rn")


def header_pays(payer: Column) -> Column:
    """Payers whose facility claims are paid once, on the header.

    The three load branches differ in this list, but each payer meets only one branch.
    """
    return payer.like("MSSP%") | payer.isin("REACH", Y_FAMILY_PAYER)


def allocate_header_paid(payer: Column, claim_type: Column, rn: Column, header_total: Column, line_paid: Column) -> Column:
    """Facility claims of those payers: the total on the first line and 0 on the others."""
    facility = header_pays(payer) & (claim_type == "Facility")
    return F.when(facility & (rn == 1), header_total).when(facility, F.lit(0)).otherwise(line_paid)


def member_facts(facts: DataFrame, category: str, shortdescr: str, out: str) -> DataFrame:
    """Distinct values of one attribute; a member with two values gives two rows."""
    hit = (F.col("fact_category") == category) & (F.col("fact_shortdescr") == shortdescr)
    return facts.where(hit).select(*MEMBER_KEY, F.col("fact").alias(out)).distinct()


def bucket_facts(family: Mapping[str, DataFrame], buckets: int | None = None, pairs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The family with its claim facts in buckets of the claim key; for facts that the warehouse does not keep so itself.

    With ``pairs`` only the facts of these (payer, LOB) are taken.
    """
    def chosen(name: str) -> DataFrame:
        return family[name] if pairs is None else family[name].join(pairs.select("payer", "lob"), ["payer", "lob"], "left_semi")

    return {**family, **{name: bucketed(chosen(name), CLAIM_SORT, name, buckets) for name in CLAIM_FACTS}}


def claim_variants(src: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """One row for each claim of ``lines`` and each ICD version, product and group that it has.

    ``nth`` numbers a claim's variants and ``variants`` counts them; ``n_lines``, ``from_date`` and ``to_date`` are the claim's.
    """
    claims = lines.groupBy(*CLAIM_SORT).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("service_dt").alias("from_date"), F.max("service_dt").alias("to_date")
    )
    header = src["claim_header"].select(
        *CLAIM_SORT, "admit_date", "discharge_date", "paid_date", "drg", "drg_desc", "claim_type", "servicing_npi",
        "bill_code_ub", "ip_admit_type", "discharge_disposition", "paid_status", "tcc_paid",
    )
    taxonomy = primary_taxonomy(src["nppes"], src["taxonomy_xwalk"]).join(src["specialty_xwalk"], "taxonomy_code", "left")
    taxonomy = taxonomy.select(
        "npi",
        F.substring("specialization", 1, 28).alias("src_specialty"),
        "milliman_specialty",
        F.substring("zip_code", 1, 5).alias("provider_zip"),
    )
    # what is looked up by member and provider are the claims and their providers alone; the headers meet them where they lie
    narrow = (
        claims.join(header.select(*CLAIM_SORT, "servicing_npi").distinct(), CLAIM_SORT, "left")
        .join(src["member"].select(*MEMBER_SORT, "dob", codes.gender_code(F.col("gender")).alias("gender"), "zip"), MEMBER_SORT, "left")
        .join(member_facts(src["fact_member"], "Member Coverage", "Product", "product"), MEMBER_SORT, "left")
        .join(member_facts(src["fact_member"], "Group Identifiers", "Group Number", "group_id"), MEMBER_SORT, "left")
    )
    narrow = narrow.join(taxonomy, spread_nulls(F.col("servicing_npi"), F.col("claim_id")) == F.col("npi"), "left").drop("npi")
    narrow = _with_headers(narrow, header)
    joined = narrow.join(dx_slots(src["fact_dxpx"], CLAIM_SORT), CLAIM_SORT, "left").join(px_slots(src["fact_dxpx"], CLAIM_SORT), CLAIM_SORT, "left")
    claim = Window.partitionBy(*CLAIM_SORT)
    order = [F.col(c).asc_nulls_last() for c in ("icd_version", "product", "group_id")]
    return joined.withColumns({"nth": F.row_number().over(claim.orderBy(*order)), "variants": F.count(F.lit(1)).over(claim)})


def _with_headers(claims: DataFrame, header: DataFrame) -> DataFrame:
    """Rows of a claim and a provider with each header of theirs.

    The provider is compared within the claim (see ``within_key``); as a join key, it would have both sides dealt anew.
    """
    renamed = header.select(*[F.col(c).alias(f"_h_{c}") if c in (*CLAIM_SORT, "servicing_npi") else F.col(c) for c in header.columns])
    mine, theirs = F.col("servicing_npi"), F.col("_h_servicing_npi")
    cond = ((mine >= theirs) & (mine <= theirs)) | (mine.isNull() & theirs.isNull())
    for k in CLAIM_SORT:
        cond = cond & (F.col(k) == F.col(f"_h_{k}"))
    return claims.join(renamed, cond, "left").drop(*[f"_h_{k}" for k in (*CLAIM_SORT, "servicing_npi")])


def hcg_claims(src: Mapping[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """The extract over one family of source tables."""
    lines = rank_claim_lines(src["fact_service"])
    variants = bucketed(claim_variants(src, src["fact_service"].where(F.col("member_id") != codes.SENTINEL_MEMBER)), CLAIM_SORT, "claim_variants", placed=True)
    sizes = variants.where(F.col("nth") == 1).select(*CLAIM_SORT, (F.col("n_lines") * F.col("variants")).alias("size"))
    order = [F.col(c).asc_nulls_last() for c in ("member_id", "claim_id")]
    starts = bucketed(running_starts(sizes, ["payer", "lob"], order, "size", "start").drop("size"), CLAIM_SORT, "claim_starts")

    def numbered(named: bool) -> DataFrame:
        """Lines of claims with an id meet on the claim key; those without one are a claim of their member."""
        key, has_id = (CLAIM_SORT, F.col("claim_id").isNotNull()) if named else (MEMBER_SORT, F.col("claim_id").isNull())
        drop = [] if named else ["claim_id"]
        return (
            lines.where(has_id)
            .join(variants.where(has_id).drop(*drop), key)
            .join(starts.where(has_id).drop(*drop), key)
            .withColumn("sequencenumber", F.col("start") + (F.col("rn") - 1) * F.col("variants") + F.col("nth"))
        )

    return stack([_extract_columns(numbered(named), as_of) for named in (True, False)])


def _extract_columns(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    c = F.col
    blank = typed_null("string")
    # --- fixed values: the target's column names, in target order ---------------
    columns: dict[str, Column] = {
        "sequencenumber": c("sequencenumber"),
        "payer": c("payer"),
        "claimid": c("claim_id"),
        "linenum": blank,
        "contractid": c("member_id"),
        "memberid": c("member_id"),
        "dob": c("dob"),
        "gender": c("gender"),
        "fromdate": c("from_date"),
        "todate": c("to_date"),
        "admitdate": c("admit_date"),
        "dischdate": c("discharge_date"),
        "paiddate": c("paid_date"),
        "drg": lpad_code(c("drg"), 4),
        "drgversion": codes.drg_version(c("drg_desc")),
        "revcode": pad_if(c("revenue_code"), 4),
        "hcpcs": c("service_code"),
        "modifier": c("cpt_modifier1"),
        "modifier2": c("cpt_modifier2"),
        "srcpos": c("place_of_service"),
        "pos": codes.normalize_pos(c("place_of_service")),
        "srcspecialty": c("src_specialty"),
        "specialty": c("milliman_specialty"),
        "encounterflag": keep_if_len(c("cap_claim_ind"), 1),
        "providerid": c("servicing_npi"),
        "providerzip": c("provider_zip"),
        "providercounty": blank,
        "renderingproviderid": c("servicing_npi"),
        "renderingproviderzip": c("provider_zip"),
        "renderingprovidercounty": blank,
        "medicareid": blank,
        "billtype": c("bill_code_ub"),
        "admitsource": blank,
        "admittype": codes.admit_type(c("ip_admit_type")),
        "billed": F.lit("0.1"),
        "allowed": c("allowed_amount"),
        "paid": allocate_header_paid(c("payer"), c("claim_type"), c("rn"), c("tcc_paid"), c("paid_amount")),
        **{n: blank for n in ("cob", "copay", "coinsurance", "deductible", "patientpay")},
        "days": los_days(c("discharge_date"), c("admit_date")),
        "units": c("unit_count"),
        "dischargestatus": c("discharge_disposition"),
        "icdversion": c("icd_version"),
        "admitdiag": blank,
        **{f"icddiag{i}": c("dx")[i]["code"] for i in range(1, SLOTS + 1)},
        **{f"poa{i}": c("dx")[i]["poa"] for i in range(1, SLOTS + 1)},
        **{f"icdproc{i}": c("px")[i]["code"] for i in range(1, SLOTS + 1)},
        "riskpool": blank,
        "oon": blank,
        "claimlinestatus": codes.paid_status(c("paid_status")),
        "currentallowed": c("paid_status"),
        "loinc": blank,
        "srclob": c("lob"),
        "lob": codes.lob_code(c("lob")),
        "srcproduct": c("product"),
        "product": c("product"),
        "groupid": c("group_id"),
        "zip": F.substring("zip", 1, 5),
        "county": blank,
        "memberstatus": blank,
        "userdefpop1": c("payer"),
        **{n: blank for n in ("userdefpop2", "userdefpop3", "userdefnum1", "userdefnum2", "userdefnum3")},
        "load_date": as_date(as_of),
    }
    # -----------------------------------------------------------------------------
    return df.select(*[expr.alias(name) for name, expr in columns.items()])


def control_branches(control: DataFrame) -> DataFrame:
    """Active (payer, LOB) pairs with their branch: A and C read the X family, B the Y family."""
    branch = F.when(F.col("payer").isin(*LIST_A_PAYERS), "A").when(F.col("payer") == Y_FAMILY_PAYER, "B").otherwise("C")
    return control.where(F.col("is_curr_flg") == 1).select("payer", "lob").distinct().withColumn("branch", branch)


def load_hcg(
    control: DataFrame,
    x_family: Mapping[str, DataFrame],
    y_family: Mapping[str, DataFrame],
    as_of: dt.date | str,
) -> DataFrame:
    """Control-driven load as one plan: every active (payer, LOB) at once, no driver loop.

    A (payer, LOB) is of one family, so the families' extracts are independent; if one set of tables serves both, it is read once.
    """
    # written, so that Spark knows its size and the fact tables stay where they are
    active = stored(control_branches(control), "control")

    def extract(family: Mapping[str, DataFrame], chosen: DataFrame) -> DataFrame:
        keys = chosen.select("payer", "lob")
        return hcg_claims({**family, **{n: family[n].join(keys, ["payer", "lob"], "left_semi") for n in FAMILY_TABLES}}, as_of)

    shared = {n: t for n, t in x_family.items() if n not in FAMILY_TABLES}
    if all(x_family[n] is y_family[n] for n in FAMILY_TABLES):
        return extract(x_family, active)
    return stack([extract(x_family, active.where(F.col("branch") != "B")), extract({**y_family, **shared}, active.where(F.col("branch") == "B"))])
