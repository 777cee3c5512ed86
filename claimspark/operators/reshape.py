"""Wide and long reshaping: slot pivots, paired unpivot, latest-N spread."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions.compat import try_int
from claimspark.operators.ranking import keep_first, top_n


def spread(df: DataFrame, keys: Sequence[str], slot: Column, slots: Sequence, cols: Mapping[str, str]) -> DataFrame:
    """Pivot by conditional maximum: one shuffle on ``keys``, with partial aggregation.

    ``cols`` maps a source column to an output name pattern such as ``"D{}_D"``.
    """
    tagged = df.withColumn("_slot", slot)
    aggs = [
        F.max(F.when(F.col("_slot") == F.lit(s), F.col(src))).alias(pattern.format(s))
        for src, pattern in cols.items()
        for s in slots
    ]
    return tagged.groupBy(*keys).agg(*aggs)


def dx_codes(dxpx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct diagnosis codes of each claim with their ICD version and slot.

    A code's slot is its smallest slot label compared as text ('10' before '2').
    """
    version = F.max(F.when(F.col("code_desc") == "DXICD9", "09").when(F.col("code_desc") == "DXICD10", "10"))
    return (
        dxpx.where(F.col("code_desc").like("DX%"))
        .groupBy(*keys, "code", "poa")
        .agg(version.alias("icd_version"), try_int(F.min("prmry_ind")).alias("slot"))
    )


def dx_wide(dxpx: DataFrame, keys: Sequence[str], n: int = 30) -> DataFrame:
    """Diagnosis codes and present-on-admission flags by slot.

    The ICD version is part of the key, so a claim coded in both versions gives two rows.
    """
    return spread(dx_codes(dxpx, keys), [*keys, "icd_version"], F.col("slot"), range(1, n + 1), {"code": "D{}_D", "poa": "D{}_P"})


def px_wide(dxpx: DataFrame, keys: Sequence[str], n: int = 30) -> DataFrame:
    """Procedure codes by slot, one row per claim."""
    codes = dxpx.where(F.col("code_desc").like("PX%"))
    return spread(codes, keys, try_int(F.col("prmry_ind")), range(1, n + 1), {"code": "D{}_PR"})


def slots_map(df: DataFrame, keys: Sequence[str], cols: Sequence[str], out: str) -> DataFrame:
    """The largest values of ``cols`` by slot as one map a key; narrow where ``spread`` has a column for each slot.

    A key whose rows have no slot keeps an empty map.
    """
    each = df.groupBy(*keys, "slot").agg(*[F.max(c).alias(c) for c in cols])
    entry = F.when(F.col("slot").isNotNull(), F.struct("slot", F.struct(*cols)))
    return each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(out))


def dx_slots(dxpx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dx_wide`` as a map from the slot to its code and flag."""
    return slots_map(dx_codes(dxpx, keys), [*keys, "icd_version"], ["code", "poa"], "dx")


def px_slots(dxpx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``px_wide`` as a map from the slot to its code."""
    codes = dxpx.where(F.col("code_desc").like("PX%")).withColumn("slot", try_int(F.col("prmry_ind")))
    return slots_map(codes, keys, ["code"], "px")


def taxonomy_long(
    nppes: DataFrame,
    ids: Sequence[str],
    n: int = 15,
    code_pattern: str = "hc_prov_taxon_cd_{}",
    switch_pattern: str = "hc_prov_prim_taxon_switch_{}",
) -> DataFrame:
    """Paired slots to rows with the slot label as text; slots without a code are dropped."""
    pairs = [
        F.struct(
            F.lit(str(i)).alias("ind"),
            F.col(code_pattern.format(i)).alias("taxonomy_code"),
            F.col(switch_pattern.format(i)).alias("primary_switch"),
        )
        for i in range(1, n + 1)
    ]
    return nppes.select(*ids, F.inline(F.array(*pairs))).where(F.col("taxonomy_code").isNotNull())


def primary_taxonomy(nppes: DataFrame, xwalk: DataFrame, n: int = 15) -> DataFrame:
    """One taxonomy per NPI: the primary switch first, then the slot label in text order."""
    long = taxonomy_long(nppes, ["npi", "prov_bus_mail_addr_postal_cd"], n)
    best = keep_first(
        long,
        ["npi"],
        [F.when(F.col("primary_switch") == "Y", 1).otherwise(0).desc(), F.col("ind").asc_nulls_last(), F.col("taxonomy_code").asc_nulls_last()],
    )
    dim = xwalk.select(F.col("code").alias("taxonomy_code"), "classification", "specialization", "pcp_spc")
    return best.join(dim, "taxonomy_code", "left").select(
        "npi",
        F.col("prov_bus_mail_addr_postal_cd").alias("zip_code"),
        "taxonomy_code",
        F.col("classification").alias("primary_specialty"),
        "specialization",
        "pcp_spc",
    )


def latest_n_wide(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Mapping[str, str], n: int, where: Column | None = None
) -> DataFrame:
    """Rank once, keep the first ``n`` per key, spread them to columns: one join instead of ``n``."""
    rows = df if where is None else df.where(where)
    ranked = top_n(rows, keys, order, n, "_rn")
    return spread(ranked, keys, F.col("_rn"), range(1, n + 1), cols)
