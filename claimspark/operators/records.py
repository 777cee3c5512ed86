"""Normalising drifted JSON records. Each record is parsed once, to a VARIANT; the rules are column
expressions on it, so a presence test, a JSON null and a wrong type stay distinguishable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PASS_WORDS = ("pass", "passed", "valid", "true", "ok")
CELL_TYPES = ("code", "markdown")
DEFAULT_ISSUE = "Unspecified review issue"
DEFAULT_SUMMARY = "Review completed."
BAD_RESPONSE = "Reviewer returned invalid response type."
BAD_SUMMARY = "Reviewer response was malformed."
# -----------------------------------------------------------------------------

TABLE_ALIASES = ("name", "table_name", "object_name")


def parse(json_col: str) -> Column:
    return F.try_parse_json(F.col(json_col))


def is_kind(v: Column, kind: str) -> Column:
    """Whether a variant is an ``OBJECT``, ``ARRAY`` or ``STRING``; false for NULL."""
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def field(v: Column, name: str) -> Column:
    """A field as a variant: NULL when absent, a variant null when it is JSON null."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def text(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def blank(c: Column) -> Column:
    return c.isNull() | (F.regexp_replace(c, r"(?U)\s+", "") == "")


def first_present(v: Column, names: Sequence[str], default: str) -> Column:
    """The first key that is present, even if its value is null (then the text ``None``)."""
    expr = F.lit(default)
    for name in reversed(names):
        expr = F.when(field(v, name).isNotNull(), F.coalesce(text(v, name), F.lit("None"))).otherwise(expr)
    return expr


def items(v: Column, name: str) -> Column:
    """The items of a list field; an empty list when the field is absent or not a list."""
    return F.coalesce(F.try_variant_get(v, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))


def objects(v: Column, name: str) -> Column:
    """The object items of a list field; everything else is dropped."""
    return F.filter(items(v, name), lambda e: is_kind(e, "OBJECT"))


def strings(v: Column, name: str) -> Column:
    """A list field as texts; null items read ``None``."""
    return F.transform(items(v, name), lambda e: F.coalesce(F.try_variant_get(e, "$", "string"), F.lit("None")))


def table_name(item: Column) -> Column:
    """``table``, or the first non-empty of its known aliases."""
    own = text(item, "table")
    aliases = [F.nullif(text(item, a), F.lit("")) for a in TABLE_ALIASES]
    return F.when(blank(own), F.coalesce(*aliases, own)).otherwise(own)


def first_or_text(item: Column, name: str) -> Column:
    """A text field that may arrive as a list: its first item, or ``''``."""
    listed = F.try_variant_get(item, f"$.{name}", "array<variant>")
    first = F.try_variant_get(F.get(listed, F.lit(0)), "$", "string")
    return F.coalesce(F.when(is_kind(field(item, name), "ARRAY"), first).otherwise(text(item, name)), F.lit(""))


def joined_or_text(item: Column, name: str) -> Column:
    """A value that may arrive as a list: its items quoted and joined by commas."""
    quoted = F.transform(strings(item, name), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.coalesce(F.when(is_kind(field(item, name), "ARRAY"), F.array_join(quoted, ", ")).otherwise(text(item, name)), F.lit(""))


def _string_list(item: Column, name: str) -> Column:
    return strings(item, name)


def explode_section(df: DataFrame, json_col: str, section: str, fields: Mapping[str, object]) -> DataFrame:
    """One row per object item of a list section, with its position among the kept items."""
    keep = [c for c in df.columns if c != json_col]
    rows = df.select(*keep, F.posexplode(objects(parse(json_col), section)).alias("pos", "_item"))
    item = F.col("_item")
    return rows.select(*keep, F.lit(section).alias("section"), "pos", *[fn(item).alias(n) for n, fn in fields.items()])


def normalize_tables(df: DataFrame, json_col: str, section: str) -> DataFrame:
    """``source_tables`` / ``output_tables`` / ``intermediate_tables`` items with defaults filled."""
    schema = lambda i: F.coalesce(text(i, "schema_name"), F.when(field(i, "schema_name").isNull(), text(i, "schema")), F.lit(""))
    default = lambda name, value: lambda i: F.coalesce(text(i, name), F.lit(value))
    fields = {
        "schema_name": schema,
        "table_name": table_name,
        "description": default("description", ""),
        "access_method": default("access_method", "direct"),
        "columns_used": lambda i: _string_list(i, "columns_used"),
    }
    return explode_section(df, json_col, section, fields)


def normalize_variables(df: DataFrame, json_col: str) -> DataFrame:
    return explode_section(
        df, json_col, "macro_variables", {"name": lambda i: text(i, "name"), "value": lambda i: joined_or_text(i, "value")}
    )


def normalize_blocks(df: DataFrame, json_col: str) -> DataFrame:
    """Transformation blocks; a missing name becomes ``block_<id>`` or ``block_<position>``."""
    raw = explode_section(
        df,
        json_col,
        "transformation_blocks",
        {
            "_name": lambda i: text(i, "name"),
            "_id": lambda i: text(i, "block_id"),
            "type": lambda i: F.coalesce(text(i, "type"), F.lit("")),
            "output_table": lambda i: first_or_text(i, "output_table"),
            "logic_summary": lambda i: F.coalesce(text(i, "logic_summary"), F.lit("")),
        },
    )
    made = F.concat(F.lit("block_"), F.coalesce(F.col("_id"), (F.col("pos") + 1).cast("string")))
    return raw.withColumn("name", F.when(blank(F.col("_name")), made).otherwise(F.col("_name"))).drop("_name", "_id")


def normalize_models(df: DataFrame, json_col: str) -> DataFrame:
    """Planned models; numbering counts every list item, so dropped items leave gaps."""
    keep = [c for c in df.columns if c != json_col]
    rows = df.select(*keep, F.posexplode(items(parse(json_col), "models")).alias("pos", "_item")).where(is_kind(F.col("_item"), "OBJECT"))
    i = F.col("_item")
    parts = F.array_join(F.filter(F.transform(items(i, "logic"), lambda e: F.try_variant_get(e, "$", "string")), lambda x: x.isNotNull()), " ")
    name = F.coalesce(F.nullif(text(i, "name"), F.lit("")), F.nullif(text(i, "model_name"), F.lit("")), F.concat(F.lit("stage_"), (F.col("pos") + 1).cast("string")))
    return rows.select(
        *keep,
        "pos",
        name.alias("name"),
        F.coalesce(F.nullif(text(i, "layer"), F.lit("")), F.lit("notebook_stage")).alias("layer"),
        F.coalesce(F.nullif(text(i, "materialization"), F.lit("")), F.lit("table")).alias("materialization"),
        strings(i, "sources").alias("sources"),
        strings(i, "depends_on").alias("depends_on"),
        F.when(is_kind(field(i, "logic"), "ARRAY"), parts).otherwise(F.when(field(i, "logic").isNull(), "").otherwise(F.coalesce(text(i, "logic"), F.lit("None")))).alias("logic"),
    )


def _issue(e: Column) -> Column:
    plain = F.struct(
        F.lit("").alias("file"),
        F.try_variant_get(e, "$", "string").alias("issue"),
        F.lit("warning").alias("severity"),
        F.lit("").alias("fix_suggestion"),
    )
    full = F.struct(
        first_present(e, ["file", "cell", "path"], "").alias("file"),
        first_present(e, ["issue", "message", "finding"], DEFAULT_ISSUE).alias("issue"),
        F.lower(first_present(e, ["severity"], "warning")).alias("severity"),
        first_present(e, ["fix_suggestion", "recommendation"], "").alias("fix_suggestion"),
    )
    return F.when(is_kind(e, "STRING"), plain).otherwise(full)


def normalize_reviews(df: DataFrame, json_col: str) -> DataFrame:
    """Review verdicts in one shape, with the next step of the pipeline as ``status``."""
    v = F.col("_v")
    keep = [c for c in df.columns if c != json_col]
    base = df.select(*keep, parse(json_col).alias("_v")).withColumn("_object", is_kind(v, "OBJECT"))
    verdict = F.lower(F.trim(F.coalesce(text(v, "overall_verdict"), F.lit("")))).isin(*PASS_WORDS)
    given = F.lower(text(v, "is_valid")).isin("true", "1", "yes", "on", "t", "y")
    issues = F.transform(F.filter(items(v, "issues"), lambda e: is_kind(e, "STRING") | is_kind(e, "OBJECT")), _issue)
    bad = F.array(
        F.struct(F.lit("").alias("file"), F.lit(BAD_RESPONSE).alias("issue"), F.lit("error").alias("severity"), F.lit("").alias("fix_suggestion"))
    )
    valid = F.when(field(v, "is_valid").isNotNull(), F.coalesce(given, F.lit(False))).otherwise(verdict)
    summary = first_present(v, ["summary", "review_summary", "overall_summary"], DEFAULT_SUMMARY)
    out = base.select(
        *keep,
        F.when(F.col("_object"), valid).otherwise(F.lit(False)).alias("is_valid"),
        F.when(F.col("_object"), issues).otherwise(bad).alias("issues"),
        F.when(F.col("_object"), summary).otherwise(F.lit(BAD_SUMMARY)).alias("summary"),
    )
    has_error = F.exists("issues", lambda i: i["severity"] == "error")
    status = (
        F.when(~F.col("is_valid") & has_error, "needs_fix").when(F.col("is_valid"), "complete").otherwise("complete_with_warnings")
    )
    return out.withColumn("status", status)


def split_valid(df: DataFrame, json_col: str, section: str) -> tuple[DataFrame, DataFrame]:
    """Items of a file section that have ``path`` and ``content``, and the quarantined rest."""
    keep = [c for c in df.columns if c != json_col]
    rows = df.select(*keep, F.posexplode(items(parse(json_col), section)).alias("pos", "_item"))
    i = F.col("_item")
    ok = is_kind(i, "OBJECT") & field(i, "path").isNotNull() & field(i, "content").isNotNull()
    good = rows.where(ok).select(*keep, "pos", text(i, "path").alias("path"), text(i, "content").alias("content"))
    bad = rows.where(~ok).select(*keep, "pos", F.coalesce(F.to_json(i), F.lit("null")).alias("item"))
    return good, bad


def normalize_cells(df: DataFrame, json_col: str) -> DataFrame:
    """Notebook cells that have a source; an unknown cell type becomes ``code``."""
    keep = [c for c in df.columns if c != json_col]
    rows = df.select(*keep, F.posexplode(F.filter(objects(parse(json_col), "notebook_cells"), lambda e: field(e, "source").isNotNull())).alias("pos", "_item"))
    kind = text(F.col("_item"), "cell_type")
    return rows.select(
        *keep, "pos", F.when(kind.isin(*CELL_TYPES), kind).otherwise("code").alias("cell_type"), text(F.col("_item"), "source").alias("source")
    )




# --- fixed values: project files that an issue about their subject brings along, and what names that subject ---
RELATED_FILES = (
    ("models/sources.yml", "source", "sources"),
    ("models/schema.yml", "schema", "schema"),
    ("dbt_project.yml", "dbt_project", "dbt_project"),
)
# -----------------------------------------------------------------------------


def select_to_fix(files: DataFrame, issues: DataFrame) -> DataFrame:
    """Files named by an error-level issue; all files when none is named.

    A file is named by its path, its name or its stem, a notebook cell by its path or ``cell_<n>``. A project file is
    also taken if an error's file, or its text if there is a column ``issue``, speaks of its subject and it has content.
    """
    errors = issues.where(F.col("severity") == "error")
    wanted = errors.where(F.col("file") != "").select(F.trim("file").alias("_want")).distinct()
    name = F.element_at(F.split("path", "/"), -1)
    cell = F.col("path").startswith("notebook/")
    keys = F.when(cell, F.array("path", F.regexp_replace(name, r"\.py$", ""))).otherwise(
        F.array("path", name, F.regexp_replace(name, r"\.sql$", ""))
    )
    keyed = files.withColumn("_keys", F.array_distinct(keys))
    hits = keyed.select("path", F.explode("_keys").alias("_key")).join(wanted, F.col("_key") == F.col("_want"), "left_semi").select("path")
    said = F.lower("issue") if "issue" in issues.columns else F.lit("")
    about = [F.when(F.lower("file").contains(in_file) | said.contains(in_issue), F.lit(path)) for path, in_file, in_issue in RELATED_FILES]
    related = errors.select(F.explode(F.array_compact(F.array(*about))).alias("path"))
    filled = files.where(F.length("content") > 0).select("path")
    chosen = hits.unionByName(related.join(filled, "path", "left_semi")).select(F.col("path").alias("_path")).distinct()
    marked = files.join(chosen, F.col("path") == F.col("_path"), "left")
    return marked.where(F.col("_path").isNotNull() | (chosen.agg(F.count(F.lit(1))).scalar() == 0)).drop("_path")
