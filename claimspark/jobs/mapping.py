"""Resolving table and column references against a column mapping: exact first, then fuzzy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.operators.matching import fuzzy_match
from claimspark.operators.ranking import keep_first
from claimspark.session import stored

# --- fixed values -----------------------------------------------------------
TABLE_CUTOFF = 0.6
COLUMN_CUTOFF = 0.7
WORK_SCHEMAS = ("work", "")
# -----------------------------------------------------------------------------


def mapping_tables(mapping: DataFrame) -> DataFrame:
    """One target per source table: that of its first mapping row (``pos`` is the file order)."""
    first = F.min_by(F.struct("target_schema", "target_table"), F.col("pos"))
    return (
        mapping.groupBy(F.lower("source_schema").alias("map_schema"), F.lower("source_table").alias("map_table"))
        .agg(first.alias("_t"))
        .select("map_schema", "map_table", F.col("_t.target_schema").alias("target_schema"), F.col("_t.target_table").alias("target_table"))
    )


def mapping_columns(mapping: DataFrame) -> DataFrame:
    """One target column per source column: the last mapping row wins."""
    return mapping.groupBy(
        F.lower("source_schema").alias("map_schema"),
        F.lower("source_table").alias("map_table"),
        F.lower("source_column").alias("map_column"),
    ).agg(F.max_by("target_column", "pos").alias("target_column"))


def resolve_exact(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Case-insensitive lookup of ``(schema_name, table_name, column_name)`` references."""
    tables, columns = mapping_tables(mapping), mapping_columns(mapping)
    keyed = refs.withColumns(
        {"map_schema": F.lower("schema_name"), "map_table": F.lower("table_name"), "map_column": F.lower("column_name")}
    )
    return (
        keyed.join(tables, ["map_schema", "map_table"], "left")
        .join(columns, ["map_schema", "map_table", "map_column"], "left")
        .drop("map_schema", "map_table", "map_column")
    )


def split_skipped(refs: DataFrame, intermediates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): work tables that the script itself makes are skipped, not unresolved."""
    made = intermediates.select(F.lower("table_name").alias("_made")).distinct()
    is_work = F.lower(F.coalesce("schema_name", F.lit(""))).isin(*WORK_SCHEMAS)
    flagged = refs.join(made, F.lower("table_name") == F.col("_made"), "left").withColumn("_skip", is_work & F.col("_made").isNotNull())
    plain = flagged.drop("_made")
    return plain.where(~F.col("_skip")).drop("_skip"), plain.where(F.col("_skip")).drop("_skip")


def resolve_tables(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each distinct (schema, table) with its mapping table: exact, else fuzzy on the name alone.

    The same name in two schemas resolves to the smallest schema.
    """
    tables = mapping_tables(mapping)
    wanted = refs.select("schema_name", "table_name").distinct()
    exact = wanted.withColumns({"map_schema": F.lower("schema_name"), "map_table": F.lower("table_name")}).join(
        tables, ["map_schema", "map_table"], "left"
    )
    found = exact.where(F.col("target_table").isNotNull()).withColumn("how", F.lit("exact"))
    open_refs = exact.where(F.col("target_table").isNull()).select("schema_name", "table_name")
    guessed = fuzzy_match(open_refs, "table_name", tables, "map_table", TABLE_CUTOFF)
    smallest = keep_first(tables, ["map_table"], [F.col("map_schema").asc()]).withColumnRenamed("map_table", "match")
    guessed = guessed.join(smallest, "match", "left").withColumn("how", F.when(F.col("match").isNotNull(), "fuzzy").otherwise("unresolved"))
    guessed = guessed.withColumnRenamed("match", "map_table")
    cols = ["schema_name", "table_name", "map_schema", "map_table", "target_schema", "target_table", "how"]
    return found.select(*cols).unionByName(guessed.select(*cols))


def resolve_columns(refs: DataFrame, tables: DataFrame, mapping: DataFrame) -> DataFrame:
    """Column references of resolved tables: exact within the matched table, else fuzzy within it."""
    columns = mapping_columns(mapping)
    wanted = refs.join(tables, ["schema_name", "table_name"]).withColumn("map_column", F.lower("column_name"))
    exact = wanted.join(columns, ["map_schema", "map_table", "map_column"], "left")
    known = exact.where(F.col("target_column").isNotNull()).withColumns({"column_how": F.lit("exact"), "map_match": F.col("map_column")})
    # names stay inside their table because the table is part of what is compared
    open_cols = exact.where(F.col("target_column").isNull() & F.col("map_table").isNotNull()).drop("target_column")
    guesses = _fuzzy_within_table(open_cols, columns)
    kept = exact.where(F.col("map_table").isNull()).withColumns({"target_column": F.col("column_name"), "column_how": F.lit("kept"), "map_match": F.lit(None).cast("string")})
    names = [
        "schema_name", "table_name", "column_name", "target_schema", "target_table", "target_column", "how", "column_how", "map_table", "map_match",
    ]
    return known.select(*names).unionByName(guesses.select(*names)).unionByName(kept.select(*names))


def _fuzzy_within_table(refs: DataFrame, columns: DataFrame) -> DataFrame:
    """Each open column meets the columns of its table that can reach the cutoff."""
    key = ["map_schema", "map_table"]
    wanted = refs.select(*key, "map_column").distinct()
    names = columns.select(*key, F.col("map_column").alias("_name"))
    guessed = fuzzy_match(wanted, "map_column", names, "_name", COLUMN_CUTOFF, key)
    found = columns.withColumnRenamed("map_column", "match")
    best = guessed.join(found, [*key, "match"]).withColumnRenamed("match", "map_match")
    how = F.when(F.col("target_column").isNotNull(), "fuzzy").otherwise("unresolved")
    return refs.join(best, [*key, "map_column"], "left").withColumn("column_how", how)


def resolve_mappings(refs: DataFrame, intermediates: DataFrame, mapping: DataFrame) -> DataFrame:
    """The resolution report in long form: one row per column reference, with how it was found.

    ``how`` is ``exact``, ``fuzzy``, ``unresolved`` (names kept) or ``skipped``.
    """
    kept, skipped = split_skipped(refs, intermediates)
    tables = stored(resolve_tables(kept, mapping), "tables")  # names are scored once; three steps read the result
    out = resolve_columns(kept, tables, mapping).withColumns(
        {
            "target_schema": F.coalesce("target_schema", "schema_name"),
            "target_table": F.coalesce("target_table", "table_name"),
        }
    )
    dropped = skipped.select(
        "schema_name", "table_name", "column_name", F.lit(None).cast("string").alias("target_schema"),
        F.lit(None).cast("string").alias("target_table"), F.lit(None).cast("string").alias("target_column"),
        F.lit("skipped").alias("how"), F.lit("skipped").alias("column_how"), F.lit(None).cast("string").alias("map_table"),
        F.lit(None).cast("string").alias("map_match"),
    )
    return out.unionByName(dropped)


def resolution_notes(resolved: DataFrame) -> DataFrame:
    """What the report says beside its tables: rows (kind, note), each note once.

    ``warning``: a fuzzy match of a table or a column, and that some tables keep their names; ``unresolved_table`` and
    ``skipped_table``: the tables by their dotted names.
    """
    c = F.col
    dotted = F.when(c("schema_name") != "", F.concat_ws(".", "schema_name", "table_name")).otherwise(c("table_name"))
    kept_names = "Some objects were not mapped explicitly. Original Oracle object names are retained for those objects."

    def notes(rows: DataFrame, kind: str, note: Column) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), note.alias("note"))

    fuzzy_table = F.concat(F.lit("Fuzzy matched table '"), "table_name", F.lit("' -> '"), "map_table", F.lit("'"))
    fuzzy_column = F.concat(F.lit("Fuzzy matched column '"), "column_name", F.lit("' -> '"), "map_match", F.lit("' in "), "table_name")
    parts = [
        notes(resolved.where(c("how") == "fuzzy"), "warning", fuzzy_table),
        notes(resolved.where(c("column_how") == "fuzzy"), "warning", fuzzy_column),
        notes(resolved.where(c("how") == "unresolved"), "unresolved_table", dotted),
        notes(resolved.where(c("how") == "unresolved"), "warning", F.lit(kept_names)),
        notes(resolved.where(c("how") == "skipped"), "skipped_table", dotted),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def report_by_table(resolved: DataFrame) -> DataFrame:
    """The report per table reference: a map of resolved columns and a list of unresolved ones.

    A group is the distinct columns of one table, so it is no larger than that table is wide.
    """
    rows = resolved.select("schema_name", "table_name", "target_schema", "target_table", "how", "column_name", "target_column", "column_how").distinct()
    pair = F.when(F.col("column_how").isin("exact", "fuzzy", "kept"), F.struct("column_name", "target_column"))
    return rows.groupBy("schema_name", "table_name", "target_schema", "target_table", "how").agg(
        F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("column_mappings"),
        F.array_sort(F.collect_list(F.when(F.col("column_how") == "unresolved", F.col("column_name")))).alias("unresolved_columns"),
    )


def apply_mapping(df: DataFrame, renames: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Rename mapped columns (case-insensitive); unmapped ones keep their name and are reported."""
    lower = {k.lower(): v for k, v in renames.items()}
    unmapped = [c for c in df.columns if c.lower() not in lower]
    return df.withColumnsRenamed({c: lower[c.lower()] for c in df.columns if c.lower() in lower}), unmapped


def sttm(mapping: DataFrame, target_columns: DataFrame, source_types: DataFrame | None = None) -> DataFrame:
    """Source-to-target table: one row per output column, with its source or how it is made.

    ``target_columns`` has ``target_schema, target_table, target_column, target_data_type``.
    """
    key = ["target_schema", "target_table", "target_column"]
    src = mapping.select(*key, "source_schema", "source_table", "source_column").distinct()
    if source_types is not None:
        src = src.join(source_types, ["source_schema", "source_table", "source_column"], "left")
    else:
        src = src.withColumn("source_data_type", F.lit(None).cast("string"))
    one = src.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min(c).alias(c) for c in ("source_schema", "source_table", "source_column", "source_data_type")],
        F.array_join(F.array_sort(F.collect_set(F.concat_ws(".", "source_schema", "source_table", "source_column"))), "; ").alias("_all"),
    )
    n = F.coalesce(F.col("_n"), F.lit(0))
    shown = lambda c: F.when(n == 1, F.col(c)).otherwise(F.lit(""))
    rule = F.when(n == 0, "Derived").when(n == 1, "Direct").otherwise("Multiple — see comments")
    return target_columns.join(one, key, "left").select(
        *key,
        "target_data_type",
        rule.alias("transformation_rule"),
        shown("source_schema").alias("source_schema"),
        shown("source_table").alias("source_table"),
        shown("source_column").alias("source_column"),
        shown("source_data_type").alias("source_data_type"),
        F.when(n > 1, F.col("_all")).otherwise("").alias("additional_comments"),
    )
