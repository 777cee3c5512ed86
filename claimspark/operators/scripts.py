"""Text jobs over a table of scripts ``(script, text)``: cleaning, table references, lint.

Patterns use ``(?d)`` so that only ``\\n`` ends a line, and ``(?U)`` so that blanks and word
characters are Unicode ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: patterns in the order they are applied ---------------------
PLSQL_WRAPPERS = (
    (r"(?im)^\s*set\s+define\s+off\s*;\s*$", "set define off"),
    (r"(?im)^\s*set\s+serveroutput\s+on\s*;\s*$", "set serveroutput"),
    (r"(?im)^\s*show\s+errors\s*;\s*$", "show errors"),
    (r"(?m)^\s*/\s*$", "sqlplus slash terminator"),
)
SAS_INGESTION = (
    (r"""(?m)^\s*x\s+["'].*?["'];\s*$""", "shell command"),
    (r"(?m)^\s*x\s+\w+.*?;\s*$", "shell command"),
    (r"(?msi)DATA\s+\w+;\s*INFILE\s+.*?RUN;", "INFILE data step"),
    (
        r"(?msi)execute\s*\(\s*(?:INSERT\s+INTO|TRUNCATE|DROP\s+TABLE|CREATE\s+TABLE\s+\w+\s+AS\s*\n?\s*SELECT\s+\*\s+FROM\s*\n?\s*EXTERNAL)"
        r".*?\)\s*by\s+\w+;",
        "passthrough DDL/load",
    ),
    (r"(?msi)PROC\s+APPEND\s+.*?RUN;", "PROC APPEND"),
    (r"(?msi)PROC\s+DELETE\s+.*?RUN;", "PROC DELETE"),
    (r"(?msi)PROC\s+DATASETS\s+.*?(?:RUN|QUIT);", "PROC DATASETS"),
    (r"(?msi)PROC\s+EXPORT\s+.*?RUN;", "PROC EXPORT"),
)
SAS_REPORTING = (
    (r"(?msi)ODS\s+EXCEL\s+.*?;", "ODS EXCEL"),
    (r"(?msi)ODS\s+_ALL_\s+.*?;", "ODS close"),
    (r"(?msi)ODS\s+LISTING\s+.*?;", "ODS listing"),
    (r"(?msi)ODS\s+HTML\s+.*?;", "ODS HTML"),
    (r"(?msi)PROC\s+REPORT\s+.*?RUN;", "PROC REPORT"),
    (r"(?msi)PROC\s+ODSTEXT\s*;.*?RUN;", "PROC ODSTEXT"),
    (r"(?msi)PROC\s+TEMPLATE\s*;.*?RUN;", "PROC TEMPLATE"),
    (r"(?msi)FILENAME\s+\w+\s+email.*?;", "email setup"),
    (r"(?msi)DATA\s+_NULL_\s*;\s*file\s+mymail.*?RUN;", "email send"),
    (r"(?msi)TITLE\d*\s+.*?;", "TITLE statement"),
    (r"(?msi)FOOTNOTE\d*\s+.*?;", "FOOTNOTE statement"),
)
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
TARGET_PATTERNS = (
    r'(?im)\bINSERT\s+INTO\s+([A-Z0-9_$."`]+)',
    r'(?im)\bMERGE\s+INTO\s+([A-Z0-9_$."`]+)',
    r'(?im)\bUPDATE\s+([A-Z0-9_$."`]+)\b',
    r'(?im)\bTRUNCATE\s+TABLE\s+([A-Z0-9_$."`]+)',
    r'(?im)\bDELETE\s+FROM\s+([A-Z0-9_$."`]+)',
)
SOURCE_PATTERNS = (r'(?im)\bFROM\s+([A-Z0-9_$."`]+)', r'(?im)\bJOIN\s+([A-Z0-9_$."`]+)')
#: Lower-case literals that a match of each pattern contains; without i, k and s, which have other letters of the same upper case.
TARGET_NEEDLES = (("ert", "nto"), ("merge", "nto"), ("update",), ("truncate",), ("delete",))
SOURCE_NEEDLES = (("from",), ("jo",))
NOT_TABLES = ("dual", "select")
PREVIEW_CHARS = 120
# -----------------------------------------------------------------------------

# (rule, pattern, severity, advice, lower-case literals of which a match contains one)
LINT_RULES = (
    ("nvl", r"(?i)(^|[^A-Za-z0-9_])NVL\s*\(", "error", "use coalesce", ("nvl",)),
    ("decode", r"(?i)(^|[^A-Za-z0-9_])DECODE\s*\(", "error", "use when / otherwise", ("decode",)),
    ("rowid", r"(?i)(^|[^A-Za-z0-9_])ROWID([^A-Za-z0-9_]|$)", "error", "use a keep-first window", ("rowid",)),
    ("forall", r"(?i)(^|[^A-Za-z0-9_])FORALL([^A-Za-z0-9_]|$)", "error", "use a set-based write", ("forall",)),
    ("bulk_collect", r"(?i)(^|[^A-Za-z0-9_])BULK\s+COLLECT([^A-Za-z0-9_]|$)", "error", "use a set-based write", ("bulk",)),
    ("execute_immediate", r"(?i)(^|[^A-Za-z0-9_])EXECUTE\s+IMMEDIATE([^A-Za-z0-9_]|$)", "error", "run the statement directly", ("immediate",)),
    ("exception_block", r"(?i)(^|[^A-Za-z0-9_])EXCEPTION\s+WHEN([^A-Za-z0-9_]|$)", "error", "use the job log", ("exception",)),
    ("collect", r"\.(collect|toPandas)\s*\(\s*\)", "error", "keep business data distributed", ("collect", "topandas")),
    ("quoted_table_name", r"(table|saveAsTable|insertInto|forName)\s*\([^)]*`", "error", "use a plain dotted name", ("`",)),
    ("date_trunc", r"(?i)(^|[^A-Za-z0-9_])DATE_TRUNC\s*\(", "error", "use ANSI date arithmetic", ("date_trunc",)),
    ("to_date", r"(?i)(^|[^A-Za-z0-9_])TO_(DATE|CHAR)\s*\(", "error", "use CAST", ("to_date", "to_char")),
    ("btrim", r"(?i)(^|[^A-Za-z0-9_])BTRIM\s*\(", "error", "use TRIM", ("btrim",)),
    ("double_colon_cast", r"[A-Za-z0-9_)]::[A-Za-z]", "error", "use CAST", ("::",)),
    ("qualify", r"(?i)(^|[^A-Za-z0-9_])QUALIFY([^A-Za-z0-9_]|$)", "error", "filter a window subquery", ("qualify",)),
    ("is_missing", r"(?i)(^|[^A-Za-z0-9_])IS\s+MISSING([^A-Za-z0-9_]|$)", "error", "use IS NULL", ("missing",)),
    ("cats_put", r"(?i)(^|[^A-Za-z0-9_])(CATS|PUT)\s*\(", "error", "use concat / CAST", ("cats", "put")),
    ("sas_attribute", r"(?i)(^|[^A-Za-z0-9_])(FORMAT|LABEL)\s*=", "error", "drop the attribute", ("format", "label")),
    ("unquoted_var", r"(?i)CAST\s*\(\s*\{\{\s*var", "error", "quote the variable", ("cast",)),
)


# A literal, lower-cased, that any match of the pattern must contain: a cheap test before the regex.
NEEDLES = {
    "set define off": "define",
    "set serveroutput": "serveroutput",
    "show errors": "errors",
    "sqlplus slash terminator": "/",
    "INFILE data step": "infile",
    "passthrough DDL/load": "execute",
    "PROC APPEND": "append",
    "PROC DELETE": "delete",
    "PROC DATASETS": "datasets",
    "PROC EXPORT": "export",
    "ODS EXCEL": "excel",
    "ODS close": "_all_",
    "ODS listing": "listing",
    "ODS HTML": "html",
    "PROC REPORT": "report",
    "PROC ODSTEXT": "odstext",
    "PROC TEMPLATE": "template",
    "email setup": "filename",
    "email send": "mymail",
    "TITLE statement": "title",
    "FOOTNOTE statement": "footnote",
}


def java_flags(pattern: str) -> str:
    return pattern.replace("(?", "(?dU", 1) if pattern.startswith("(?") and not pattern.startswith("(?:") else "(?dU)" + pattern


def strip(col: Column) -> Column:
    """Remove blanks of any kind at both ends."""
    return F.regexp_replace(col, r"(?U)\A\s+|\s+\z", "")


def _strip_patterns(df: DataFrame, patterns: Sequence[tuple[str, str]], kind: str, preview: int | None, where: Column | None = None) -> DataFrame:
    """Flag and remove each pattern in turn, each on the text the one before left; removed blocks are kept whole.

    With ``where`` only the scripts that it holds for are looked at.
    """
    chosen = F.lit(True) if where is None else where
    df = df.withColumn("_low", F.lower("clean"))
    for pattern, label in patterns:
        rx = java_flags(pattern)
        needle = NEEDLES.get(label)
        present = chosen & F.col("_low").contains(needle) if needle else chosen
        # each step is a column of its own: an expression inside a lambda or a condition would be worked out again at each use
        df = df.withColumn("_hits", F.when(present, F.regexp_extract_all("clean", F.lit(rx), F.lit(0))).otherwise(F.array().cast("array<string>")))
        if preview is None:
            made = F.transform("_hits", lambda m: F.concat(F.lit(f"[{kind} - {label}]: "), strip(m)))
        else:
            made = F.transform("_hits", lambda m: F.concat(F.lit(f"[{kind} - {label}]: "), strip(F.substring(m, 1, preview)), F.lit("...")))
        any_hit = F.size("_hits") > 0
        cut = F.when(any_hit, F.regexp_replace("clean", rx, "")).otherwise(F.col("clean"))
        df = df.withColumns({"flags": F.concat("flags", made), "removed": F.concat("removed", "_hits"), "clean": cut})
        df = df.withColumn("_low", F.when(any_hit, F.lower("clean")).otherwise(F.col("_low")))
    return df.drop("_hits", "_low")


def _dealt(scripts: DataFrame) -> DataFrame:
    """Regexes cost far more than a text's bytes suggest, so the scripts are dealt out by name first."""
    return scripts.repartition(int(scripts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "script")


def _start(scripts: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return _dealt(scripts).withColumns({"clean": F.col("text"), "flags": none, "removed": none})


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("clean", strip(F.regexp_replace("clean", r"\n{3,}", "\n\n"))).drop("text")


def clean_plsql(scripts: DataFrame) -> DataFrame:
    """Strip client wrapper lines, flag each, squeeze blank lines: ``(script, clean, flags, removed)``."""
    return _finish(_strip_patterns(_start(scripts), PLSQL_WRAPPERS, "WRAPPER", None))


def clean_sas(scripts: DataFrame) -> DataFrame:
    """Strip ingestion and reporting blocks, drop block comments: ``(script, clean, flags, removed)``.

    A flag previews the first characters of its block; ``removed`` has each block whole, in the same order.
    """
    df = _strip_patterns(_start(scripts), SAS_INGESTION, "INGESTION", PREVIEW_CHARS)
    df = _strip_patterns(df, SAS_REPORTING, "REPORTING", PREVIEW_CHARS)
    return _finish(df.withColumn("clean", F.regexp_replace("clean", java_flags(BLOCK_COMMENT), "")))


def _unquote(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, r'\A"+|"+\z', ""), r"\A`+|`+\z", "")


def _split_name(raw: Column) -> tuple[Column, Column]:
    """(schema, table) of a dotted name; quotes removed from the whole and from each part."""
    parts = F.transform(F.split(_unquote(raw), r"\."), _unquote)
    schema = F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise("")
    return schema, F.element_at(parts, -1)


def _captured(text: str, low: Column, pattern: str, needles: Sequence[str]) -> Column:
    """The names that a pattern captures in a text; ``low`` is the text in lower case."""
    present = reduce(lambda a, b: a & b, [low.contains(n) for n in needles])
    hits = F.regexp_extract_all(text, F.lit(java_flags(pattern)), F.lit(1))
    return F.when(present | low.isNull(), hits).otherwise(F.array().cast("array<string>"))


def _named(scripts: DataFrame, patterns: Sequence[str], needles: Sequence[Sequence[str]], text: str) -> DataFrame:
    """Every captured name with its place: pattern order first, then position in the text."""
    low = scripts.select("script", text, F.lower(text).alias("_low"))
    low = low.select("script", *[_captured(text, F.col("_low"), p, n).alias(f"_hits{k}") for k, (p, n) in enumerate(zip(patterns, needles))])

    def captures(number: int) -> Column:
        return F.transform(f"_hits{number}", lambda m, i: F.struct(F.lit(number).alias("pattern"), i.alias("at"), m.alias("raw")))

    rows = low.select("script", F.inline(F.concat(*[captures(k) for k in range(len(patterns))])))
    schema, table = _split_name(F.col("raw"))
    return rows.withColumns({"schema_name": schema, "table_name": table})


def extract_table_refs(scripts: DataFrame, text: str = "text") -> DataFrame:
    """Targets and sources of each script, first spelling kept: ``(script, role, schema_name, table_name)``.

    Sources leave out ``dual``, subqueries, and tables the script also writes.
    """
    scripts = _dealt(scripts)
    first = F.min_by(F.struct("schema_name", "table_name"), F.struct("pattern", "at")).alias("_first")
    targets = (
        _named(scripts, TARGET_PATTERNS, TARGET_NEEDLES, text)
        .groupBy("script", F.lower("raw").alias("_key"))
        .agg(first)
        .select("script", F.lit("target").alias("role"), "_first.schema_name", "_first.table_name")
    )
    written = targets.select("script", F.lower("table_name").alias("_table")).distinct()
    named = _named(scripts, SOURCE_PATTERNS, SOURCE_NEEDLES, text).where((F.col("table_name") != "") & ~F.lower("table_name").isin(*NOT_TABLES))
    full = F.when(F.col("schema_name") != "", F.concat_ws(".", "schema_name", "table_name")).otherwise(F.col("table_name"))
    sources = (
        named.groupBy("script", F.lower(full).alias("_key"))
        .agg(first)
        .select("script", F.lit("source").alias("role"), "_first.schema_name", "_first.table_name")
        .withColumn("_table", F.lower("table_name"))
        .join(written, ["script", "_table"], "left_anti")
        .drop("_table")
    )
    return targets.unionByName(sources)


def _may_fire(low: Column, rules: Sequence[tuple]) -> Column:
    """For each rule whether a text, given in lower case, holds one of its literals at all."""
    return F.array(*[reduce(lambda a, b: a | b, [low.contains(n) for n in needles]) for *_, needles in rules])


def _lint_hits(line: Column, may: Column, rules: Sequence[tuple]) -> Column:
    """The rules that fire on a line, as one array: not a join. ``may`` tells of the whole text which rules can."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    may[k] & line.rlike(pattern),
                    F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(advice).alias("fix_suggestion")),
                )
                for k, (rule, pattern, severity, advice, _) in enumerate(rules)
            ]
        )
    )


def lint_scripts(scripts: DataFrame, rules: Sequence[tuple] = LINT_RULES) -> DataFrame:
    """One row per line and rule that fires."""
    may = _may_fire(F.lower("text"), rules).alias("_may")
    lines = _dealt(scripts).select("script", "text", may).select("script", "_may", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("script", (F.col("line_no") + 1).alias("line_no"), "line", F.inline(_lint_hits(F.col("line"), F.col("_may"), rules)))


def _raw_names(text: str, low: Column, patterns: Sequence[str], needles: Sequence[Sequence[str]]) -> Column:
    """Captured names in order of pattern and place."""
    return F.concat(*(_captured(text, low, p, n) for p, n in zip(patterns, needles)))


def _distinct_names(found: str, by_raw: bool) -> Column:
    """Captured names as structs of key, schema and table, in their order."""

    def one(raw: Column) -> Column:
        schema, table = _split_name(raw)
        full = F.when(schema != "", F.concat_ws(".", schema, table)).otherwise(table)
        return F.struct(F.lower(raw if by_raw else full).alias("key"), schema.alias("schema_name"), table.alias("table_name"))

    return F.transform(found, one)


def _firsts(names: Column) -> Column:
    keys = F.transform(names, lambda n: n["key"])
    return F.filter(names, lambda n, i: F.array_position(keys, n["key"]) == i + 1)


def script_catalog(scripts: DataFrame) -> DataFrame:
    """One row per script: clean text, flags, tables written and read, lint hits and dangling references, each text read once.

    The corpus may mix dialects: a column ``kind`` says ``plsql`` (as does NULL, or no such column), ``sas``, or another name for
    scripts that need no cleaning, such as models. Tables come from the clean text, as ``schema.table`` in order of first
    mention; lint from the text as given, as ``line:rule``. ``missing`` has the models that a script refers to and that no
    script of the corpus is named as. All but these stays on the script's row, so the scripts are dealt out once.
    """
    kind = F.coalesce(F.lower("kind"), F.lit("plsql")) if "kind" in scripts.columns else F.lit("plsql")
    df = _start(scripts.select("script", "text", kind.alias("kind")))
    df = _strip_patterns(df, PLSQL_WRAPPERS, "WRAPPER", None, F.col("kind") == "plsql")
    sas = F.col("kind") == "sas"
    df = _strip_patterns(df, SAS_INGESTION, "INGESTION", PREVIEW_CHARS, sas)
    df = _strip_patterns(df, SAS_REPORTING, "REPORTING", PREVIEW_CHARS, sas)
    bare = F.when(sas, F.regexp_replace("clean", java_flags(BLOCK_COMMENT), "")).otherwise(F.col("clean"))
    df = df.withColumn("clean", strip(F.regexp_replace(bare, r"\n{3,}", "\n\n")))
    df = df.withColumns({"_low": F.lower("clean"), "_may": _may_fire(F.lower("text"), LINT_RULES)})
    low = F.col("_low")
    df = df.withColumns({"_to": _raw_names("clean", low, TARGET_PATTERNS, TARGET_NEEDLES), "_from": _raw_names("clean", low, SOURCE_PATTERNS, SOURCE_NEEDLES)})
    df = df.withColumns({"_to": _distinct_names("_to", True), "_from": _distinct_names("_from", False)})
    df = df.withColumn("_written", F.transform("_to", lambda n: F.lower(n["table_name"])))
    usable = F.filter(
        "_from",
        lambda n: (n["table_name"] != "") & ~F.lower(n["table_name"]).isin(*NOT_TABLES) & ~F.array_contains(F.col("_written"), F.lower(n["table_name"])),
    )
    dotted = lambda names: F.transform(names, lambda n: F.concat_ws(".", n["schema_name"], n["table_name"]))
    per_line = F.transform(
        F.split("text", "\n"), lambda line, i: F.transform(_lint_hits(line, F.col("_may"), LINT_RULES), lambda h: F.concat_ws(":", (i + 1).cast("string"), h["rule"]))
    )
    made = df.select("script", "clean", "flags", "removed", dotted(_firsts(F.col("_to"))).alias("targets"), dotted(_firsts(usable)).alias("sources"), F.flatten(per_line).alias("lint"))
    dangling = missing_refs(scripts.select(F.col("script").alias("model"), "text").where(F.col("text").contains("ref(")), names=scripts.select(F.col("script").alias("model")))
    dangling = dangling.groupBy(F.col("model").alias("_model")).agg(F.array_sort(F.collect_set("ref")).alias("missing"))
    joined = made.join(dangling, made["script"] == dangling["_model"], "left").drop("_model")
    return joined.withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))


def model_refs(models: DataFrame, text: str = "text") -> DataFrame:
    """Models named by ``ref('...')`` calls: ``(model, ref)``."""
    found = F.regexp_extract_all(text, F.lit(r"ref\(\s*['\"]([A-Za-z0-9_]+)['\"]\s*\)"), F.lit(1))
    return models.select("model", F.explode(F.array_distinct(found)).alias("ref"))


def missing_refs(models: DataFrame, planned: DataFrame | None = None, text: str = "text", names: DataFrame | None = None) -> DataFrame:
    """References with no model, and planned models that were not produced. ``names`` has the models that exist, if not these."""
    names = (models if names is None else names).select(F.col("model").alias("_have")).distinct()
    refs = model_refs(models, text)
    out = refs.join(names, F.col("ref") == F.col("_have"), "left_anti").select("model", "ref", F.lit("dangling_ref").alias("problem"))
    if planned is not None:
        lost = planned.select(F.col("model").alias("ref")).distinct().join(names, F.col("ref") == F.col("_have"), "left_anti")
        out = out.unionByName(lost.select(F.lit(None).cast("string").alias("model"), "ref", F.lit("missing_model").alias("problem")))
    return out
