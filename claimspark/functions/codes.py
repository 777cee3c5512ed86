"""Claim code normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimspark.functions.compat import pad_if, recode

# --- fixed values -----------------------------------------------------------
PLACE_CODES = [
    "01", "02", "03", "04", "05", "06", "07", "08", "09", "11", "12", "13", "14", "15", "16", "17", "18", "19", "20", "21", "22", "23",
    "24", "25", "26", "31", "32", "33", "34", "35", "41", "42", "49", "50", "51", "52", "53", "54", "55", "56", "57", "60", "61", "62",
    "65", "71", "72", "81", "99",
]
GENDERS = {"M": "M", "MALE": "M", "F": "F", "FEMALE": "F"}
DRG_VERSIONS = {"DRG - AP": "AP", "DRG - APR": "APR", "DRG - MS": "MS"}
ADMIT_TYPES = {
    "NEW BORN": "4",
    "NEWBORN": "4",
    "ELECTIVE": "3",
    "EMERGENT": "1",
    "EMERGENCY": "1",
    "INFORMATION NOT AVAILABLE": "9",
    "URGENT": "2",
    "TRAUMA CENTER": "5",
    "RESERVED FOR NATIONAL ASSIGNMENT": "6",
}
PAID_STATUSES = {"1": "P", "0": "D", "-1": "R"}
LOB_CODES = {"Commercial": "COM", "MA": "ADV", "Medicare": "MCR", "Medicaid": "MCD"}
ANNUAL_REASONS = ("ANNUAL PHYSICAL", "ANNUAL", "ANNUAL / FOLLOW UP", "MEDICARE ANNUAL WELLNESS VISIT")
ANNUAL_LABEL = "ANNUAL/WELL VISIT"
WELLNESS_SERVICES = ("G0402", "G0438", "G0439")
SENTINEL_MEMBER = "0" * 20
# -----------------------------------------------------------------------------


def normalize_pos(col: Column) -> Column:
    """Two-digit place of service when valid, else NULL."""
    padded = pad_if(col, 2)
    return F.when(padded.isin(PLACE_CODES), padded)


def gender_code(col: Column) -> Column:
    return recode(F.upper(col), GENDERS)


def drg_version(col: Column) -> Column:
    return recode(col, DRG_VERSIONS)


def admit_type(col: Column) -> Column:
    return recode(col, ADMIT_TYPES)


def paid_status(col: Column) -> Column:
    return recode(col, PAID_STATUSES, "P")


def lob_code(col: Column) -> Column:
    return recode(col, LOB_CODES, "UNK")


def appt_reason(col: Column) -> Column:
    """Group the annual and wellness reasons under one label; other reasons stay."""
    return F.when(F.upper(col).isin(*ANNUAL_REASONS), F.lit(ANNUAL_LABEL)).otherwise(col)


def valid_member(col: Column) -> Column:
    """Member ids that can be linked: not NULL, no ``?``, not a subscriber stub, not a zero-filled stub."""
    return (
        col.isNotNull()
        & ~col.contains("?")
        & ~F.upper(col).contains("SUBSCRIBER")
        & ~col.like("00000000%00000000")
    )
