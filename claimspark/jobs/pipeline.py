"""Loads end to end: each block writes its table, logs its run, and the next block reads the written table.

Every table switches to its new rows in one step (``VersionedTable``), so a block that fails leaves the old rows readable.
Intermediates are deleted at the end of each block. Source tables come as DataFrames; ``source_tables`` reads them from the
legacy warehouse's files with empty texts as NULL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.jobs import hcg, patient_seen, unified_member, visits
from claimspark.jobs.publish import publish_copy
from claimspark.session import scratch, stored
from claimspark.sinks.load import JobLog
from claimspark.sinks.versions import VersionedTable
from claimspark.sources.tables import read_table

CLAIMS_TARGET = "hcg_input_claims"
#: Member tables are laid out by member, as their readers look for one.
LAYOUT = ("member_id",)
COPIES = {
    "x_unified_member_visits": ("unified_member_visits", visits.VISIT_COLS, {}),
    "x_patient_seen_visits_all": ("patient_seen_visits_all", patient_seen.SEEN_COLS, {}),
    "x_patient_seen_visits_data_mart": ("patient_seen_visits_data_mart", patient_seen.COPY_COLS, patient_seen.COPY_ONLY),
}


def _path(root: str, name: str) -> str:
    return f"{root}/{name}"


def source_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of the legacy warehouse, in which an empty text is NULL."""
    return {name: read_table(spark, root, name, empty_as_null=True) for name in names}


def read_loaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a table that a block has loaded."""
    rows = VersionedTable(spark, _path(root, name)).read()
    if rows is None:
        raise LookupError(f"{name} has not been loaded to {root}")
    return rows


def load_claims(
    log: JobLog, root: str, control: DataFrame, x_family: Mapping[str, DataFrame], y_family: Mapping[str, DataFrame], as_of: dt.date
) -> bool:
    """Replace the (payer, LOB) partitions named by the control table; all other partitions stay.

    An active pair that now has no rows is emptied, in the same step. Each pair is logged with its own count; a pair that fails
    is logged with its error and keeps its old rows. True if all pairs were loaded. The pairs are a few rows of control data.
    """
    spark = control.sparkSession
    target = VersionedTable(spark, _path(root, CLAIMS_TARGET))
    pairs = [(r["payer"], r["lob"]) for r in hcg.control_branches(control).orderBy("payer", "lob").collect()]

    def write(chosen: DataFrame, named: list[tuple[str, str]]) -> dict[tuple[str, str], int]:
        with scratch(spark):
            active = stored(hcg.control_branches(chosen), "pairs")
            x = hcg.bucket_facts(x_family, pairs=active)
            y = x if y_family is x_family else hcg.bucket_facts(y_family, pairs=active)
            return target.replace_partitions(hcg.load_hcg(chosen, x, y, as_of), ["payer", "srclob"], emptied=named)

    def write_one(pair: tuple[str, str]) -> int:
        chosen = control.where((F.col("payer") == pair[0]) & (F.col("lob") == pair[1]))
        return write(chosen, [pair]).get(pair, 0)

    done = log.run_pairs(CLAIMS_TARGET, pairs, lambda: write(control, pairs), write_one)
    target.vacuum()
    return all(done.values())


def claims_job(spark: SparkSession, sources: str, root: str, log_root: str, as_of: dt.date) -> bool:
    """The claims load from the warehouse's files: ``x_`` and ``y_`` tables of both families, the crosswalks, and ``control``."""
    shared = source_tables(spark, sources, ["nppes", "taxonomy_xwalk", "specialty_xwalk", "control"])
    control = shared.pop("control")

    def family(prefix: str) -> dict[str, DataFrame]:
        tables = source_tables(spark, sources, [f"{prefix}{n}" for n in hcg.FAMILY_TABLES])
        return {**{n.removeprefix(prefix): t for n, t in tables.items()}, **shared}

    return load_claims(JobLog(spark, log_root, CLAIMS_TARGET), root, control, family("x_"), family("y_"), as_of)


def load_members(log: JobLog, spark: SparkSession, root: str, t: Mapping[str, DataFrame], as_of: dt.date) -> dict[str, bool]:
    """Visits, patient-seen tables, member report and their published copies; a failed block does not stop the next."""
    def table(name: str) -> DataFrame:
        return read_loaded(spark, root, name)

    def overwrite(name: str, rows: DataFrame) -> int:
        target = VersionedTable(spark, _path(root, name))
        count = target.replace(rows, LAYOUT)
        target.vacuum()
        return count

    def load_visits() -> int:
        return overwrite("unified_member_visits", visits.unified_visits(t, as_of))

    def load_legacy() -> int:
        return overwrite("legacy_member_visits", visits.legacy_visits(table("unified_member_visits")))

    def load_seen() -> int:
        return overwrite("patient_seen_visits_all", patient_seen.patient_seen_all(table("unified_member_visits"), t, as_of))

    def load_mart() -> int:
        return overwrite("patient_seen_visits_data_mart", patient_seen.patient_seen_mart(table("patient_seen_visits_all"), t, as_of))

    def load_report() -> int:
        # the bounds come from the previous report and are read before it is replaced
        previous = VersionedTable(spark, _path(root, "unified_member")).read()
        report = unified_member.member_reporting(t, table("legacy_member_visits"), as_of, previous)
        return overwrite("unified_member", report)

    blocks = {
        "unified_member_visits": load_visits,
        "legacy_member_visits": load_legacy,
        "patient_seen_visits_all": load_seen,
        "patient_seen_visits_data_mart": load_mart,
        "unified_member": load_report,
    }
    for target, (source, columns, unfilled) in COPIES.items():
        blocks[target] = lambda target=target, source=source, columns=columns, unfilled=unfilled: overwrite(
            target, publish_copy(table(source), columns, unfilled)
        )

    def block(fn: Callable[[], int]) -> int:
        with scratch(spark):
            return fn()

    return {name: log.run(name, lambda fn=fn: block(fn)) for name, fn in blocks.items()}
