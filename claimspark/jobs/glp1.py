"""GLP-1 fills classified by drug list and diabetes diagnosis."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions.dates import as_date
from claimspark.operators.joins import flag_exists

# --- fixed values -----------------------------------------------------------
WEIGHT_LOSS_NDCS = ("0169-7501-12", "0169-7501-13", "0169-7501-14")
DIABETES_NDCS = (
    "0169-3935-11",
    "0169-3936-11",
    "0169-3937-11",
    "00002-8215-01",
    "00002-8215-59",
    "00173-7085-01",
    "00173-7085-02",
    "00024-0590-30",
    "00024-0591-30",
)
DIABETES_DX = ("E08", "E09", "E10", "E11", "E13")
# -----------------------------------------------------------------------------


def classify_glp1(
    rx: DataFrame,
    med: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    weight_ndcs: Sequence[str] = WEIGHT_LOSS_NDCS,
    diabetes_ndcs: Sequence[str] = DIABETES_NDCS,
    dx_prefixes: Sequence[str] = DIABETES_DX,
    member: str = "member_id",
) -> DataFrame:
    """One row per fill in the inclusive date range whose NDC is on either list.

    A weight-loss drug decides on its own; a diabetes drug depends on whether the member has a
    diabetes diagnosis at any time. Filters reach both scans; the diagnosis side is reduced to
    distinct members before it is joined.
    """
    fills = rx.where(
        F.col("fill_date").between(as_date(start), as_date(end)) & F.col("ndc").isin(*weight_ndcs, *diabetes_ndcs)
    ).withColumn("drug_category", F.when(F.col("ndc").isin(*weight_ndcs), "Weight Loss GLP1").otherwise("Diabetes GLP1"))
    diabetic = med.where(F.substring("dx_code", 1, 3).isin(*dx_prefixes))
    flagged = flag_exists(fills, diabetic, {member: member}, "has_diabetes_dx")
    category = (
        F.when(F.col("drug_category") == "Weight Loss GLP1", "Weight Loss")
        .when(F.col("has_diabetes_dx") == 1, "Diabetes Management")
        .otherwise("Likely Weight Loss")
    )
    return flagged.withColumn("final_category", category)
