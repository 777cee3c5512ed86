"""Script, record and mapping queries. Scripts are built from whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimspark.jobs import mapping as mapping_job
from claimspark.operators import matching, records, scripts
from claimspark.plans.registry import query

c = F.col

# --------------------------------------------------------------------------- cleaning
SP = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def _rx(pattern: str) -> str:
    return pattern.replace(r"\s", SP)




def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SP}+|{SP}+$', '', 'g')"


# the wrapper lines as this check states them
WRAPPERS = (
    (r"(?im)^\s*set\s+define\s+off\s*;\s*$", "set define off"),
    (r"(?im)^\s*set\s+serveroutput\s+on\s*;\s*$", "set serveroutput"),
    (r"(?im)^\s*show\s+errors\s*;\s*$", "show errors"),
    (r"(?m)^\s*/\s*$", "sqlplus slash terminator"),
)


def _clean_sql() -> str:
    layers = ["select script, text as t0, [] as f0 from {scripts}"]
    for i, (pattern, label) in enumerate(WRAPPERS):
        rx = _rx(pattern)
        hit = f"list_transform(regexp_extract_all(t{i}, '{rx}'), lambda m: '[WRAPPER - {label}]: ' || {_strip('m')})"
        layers.append(f"select script, regexp_replace(t{i}, '{rx}', '', 'g') as t{i + 1}, f{i} || {hit} as f{i + 1} from (PREV)")
    sql = layers[0]
    for layer in layers[1:]:
        sql = layer.replace("PREV", sql)
    n = len(WRAPPERS)
    squeezed = f"regexp_replace(t{n}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"select script, {_strip(squeezed)} as clean, array_to_string(f{n}, chr(10)) as flags from ({sql})"


@query("clean_plsql", _clean_sql())
def clean_plsql(dom):
    return scripts.clean_plsql(dom.scripts).withColumn("flags", F.array_join("flags", "\n")).drop("removed")


# the SAS blocks as this check states them, in order
SAS_BLOCKS = (
    (r"""(?m)^\s*x\s+["'].*?["'];\s*$""", "INGESTION - shell command"),
    (r"(?m)^\s*x\s+\w+.*?;\s*$", "INGESTION - shell command"),
    (r"(?msi)DATA\s+\w+;\s*INFILE\s+.*?RUN;", "INGESTION - INFILE data step"),
    (
        r"(?msi)execute\s*\(\s*(?:INSERT\s+INTO|TRUNCATE|DROP\s+TABLE|CREATE\s+TABLE\s+\w+\s+AS\s*\n?\s*SELECT\s+\*\s+FROM\s*\n?\s*EXTERNAL).*?\)\s*by\s+\w+;",
        "INGESTION - passthrough DDL/load",
    ),
    (r"(?msi)PROC\s+APPEND\s+.*?RUN;", "INGESTION - PROC APPEND"),
    (r"(?msi)PROC\s+DELETE\s+.*?RUN;", "INGESTION - PROC DELETE"),
    (r"(?msi)PROC\s+DATASETS\s+.*?(?:RUN|QUIT);", "INGESTION - PROC DATASETS"),
    (r"(?msi)PROC\s+EXPORT\s+.*?RUN;", "INGESTION - PROC EXPORT"),
    (r"(?msi)ODS\s+EXCEL\s+.*?;", "REPORTING - ODS EXCEL"),
    (r"(?msi)ODS\s+_ALL_\s+.*?;", "REPORTING - ODS close"),
    (r"(?msi)ODS\s+LISTING\s+.*?;", "REPORTING - ODS listing"),
    (r"(?msi)ODS\s+HTML\s+.*?;", "REPORTING - ODS HTML"),
    (r"(?msi)PROC\s+REPORT\s+.*?RUN;", "REPORTING - PROC REPORT"),
    (r"(?msi)PROC\s+ODSTEXT\s*;.*?RUN;", "REPORTING - PROC ODSTEXT"),
    (r"(?msi)PROC\s+TEMPLATE\s*;.*?RUN;", "REPORTING - PROC TEMPLATE"),
    (r"(?msi)FILENAME\s+\w+\s+email.*?;", "REPORTING - email setup"),
    (r"(?msi)DATA\s+_NULL_\s*;\s*file\s+mymail.*?RUN;", "REPORTING - email send"),
    (r"(?msi)TITLE\d*\s+.*?;", "REPORTING - TITLE statement"),
    (r"(?msi)FOOTNOTE\d*\s+.*?;", "REPORTING - FOOTNOTE statement"),
)


def _sas_sql() -> str:
    sql = "select script, text as t, [] as flags, [] as removed from {sas_scripts}"
    for pattern, label in SAS_BLOCKS:
        rx = _rx(pattern).replace("'", "''")
        hits = f"regexp_extract_all(t, '{rx}')"
        made = f"list_transform({hits}, lambda m: '[{label}]: ' || {_strip('left(m, 120)')} || '...')"
        sql = f"select script, regexp_replace(t, '{rx}', '', 'g') as t, flags || {made} as flags, removed || {hits} as removed from ({sql})"
    bare = "regexp_replace(t, '(?s)/\\*.*?\\*/', '', 'g')"
    squeezed = f"regexp_replace({bare}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"""select script, {_strip(squeezed)} as clean, array_to_string(flags, chr(10)) as flags, array_to_string(removed, chr(10)) as removed from ({sql})"""


@query("clean_sas", _sas_sql())
def clean_sas(dom):
    return scripts.clean_sas(dom.sas_scripts).withColumns({"flags": F.array_join("flags", "\n"), "removed": F.array_join("removed", "\n")})


# --------------------------------------------------------------------------- table references
# Fixed values. This engine's word border knows ASCII only, so it is spelled out with Unicode classes.
NAME = r'([A-Za-z0-9_$."`]+)'
HEAD = r"(?:^|[^\p{L}\p{N}\p{M}_])"
TARGET_RX = [
    f"(?i){HEAD}INSERT{SP}+INTO{SP}+{NAME}",
    f"(?i){HEAD}MERGE{SP}+INTO{SP}+{NAME}",
    rf'(?i){HEAD}UPDATE{SP}+([A-Za-z0-9_$."`]*[A-Za-z0-9_])(?:[^\p{{L}}\p{{N}}\p{{M}}_]|$)',
    f"(?i){HEAD}TRUNCATE{SP}+TABLE{SP}+{NAME}",
    f"(?i){HEAD}DELETE{SP}+FROM{SP}+{NAME}",
]
SOURCE_RX = [f"(?i){HEAD}FROM{SP}+{NAME}", f"(?i){HEAD}JOIN{SP}+{NAME}"]


def _refs_sql(patterns: list[str], table: str = "scripts", text: str = "text") -> str:
    parts = [
        f"select script, {k} as pattern, unnest(regexp_extract_all({text}, '{rx}', 1)) as raw, generate_subscripts(regexp_extract_all({text}, '{rx}', 1), 1) as spot from {{{table}}}"
        for k, rx in enumerate(patterns)
    ]
    unq = "trim(trim({0}, '\"'), '`')"
    whole = unq.format("raw")
    part = lambda i: unq.format(f"string_split({whole}, '.')[{i}]")
    return f"""select script, pattern, spot, raw, if(instr({whole}, '.') > 0, {part(-2)}, '') as schema_name, {part(-1)} as table_name
        from ({' union all '.join(parts)})"""


L_REFS = {
    "tgt": "select * from (" + _refs_sql(TARGET_RX) + ") qualify row_number() over (partition by script, lower(raw) order by pattern, spot) = 1",
    "src": "select * from ("
    + _refs_sql(SOURCE_RX)
    + """) where table_name <> '' and lower(table_name) not in ('dual', 'select') qualify row_number() over (partition by script,
        lower(if(schema_name <> '', schema_name || '.' || table_name, table_name)) order by pattern, spot) = 1""",
}


@query(
    "table_refs",
    """select script, 'target' as role, schema_name, table_name from {tgt} union all
       select script, 'source', schema_name, table_name from {src} s where not exists
         (select 1 from {tgt} t where t.script = s.script and lower(t.table_name) = lower(s.table_name))""",
    **L_REFS,
)
def table_refs(dom):
    return scripts.extract_table_refs(dom.scripts)


# --------------------------------------------------------------------------- lint
# the rules as this check states them: name, pattern, advice; all of them are errors
LINT_TEXT = (
    ('nvl', r"(?i)(^|[^A-Za-z0-9_])NVL\s*\(", 'use coalesce'),
    ('decode', r"(?i)(^|[^A-Za-z0-9_])DECODE\s*\(", 'use when / otherwise'),
    ('rowid', r"(?i)(^|[^A-Za-z0-9_])ROWID([^A-Za-z0-9_]|$)", 'use a keep-first window'),
    ('forall', r"(?i)(^|[^A-Za-z0-9_])FORALL([^A-Za-z0-9_]|$)", 'use a set-based write'),
    ('bulk_collect', r"(?i)(^|[^A-Za-z0-9_])BULK\s+COLLECT([^A-Za-z0-9_]|$)", 'use a set-based write'),
    ('execute_immediate', r"(?i)(^|[^A-Za-z0-9_])EXECUTE\s+IMMEDIATE([^A-Za-z0-9_]|$)", 'run the statement directly'),
    ('exception_block', r"(?i)(^|[^A-Za-z0-9_])EXCEPTION\s+WHEN([^A-Za-z0-9_]|$)", 'use the job log'),
    ('collect', r"\.(collect|toPandas)\s*\(\s*\)", 'keep business data distributed'),
    ('quoted_table_name', r"(table|saveAsTable|insertInto|forName)\s*\([^)]*`", 'use a plain dotted name'),
    ('date_trunc', r"(?i)(^|[^A-Za-z0-9_])DATE_TRUNC\s*\(", 'use ANSI date arithmetic'),
    ('to_date', r"(?i)(^|[^A-Za-z0-9_])TO_(DATE|CHAR)\s*\(", 'use CAST'),
    ('btrim', r"(?i)(^|[^A-Za-z0-9_])BTRIM\s*\(", 'use TRIM'),
    ('double_colon_cast', r"[A-Za-z0-9_)]::[A-Za-z]", 'use CAST'),
    ('qualify', r"(?i)(^|[^A-Za-z0-9_])QUALIFY([^A-Za-z0-9_]|$)", 'filter a window subquery'),
    ('is_missing', r"(?i)(^|[^A-Za-z0-9_])IS\s+MISSING([^A-Za-z0-9_]|$)", 'use IS NULL'),
    ('cats_put', r"(?i)(^|[^A-Za-z0-9_])(CATS|PUT)\s*\(", 'use concat / CAST'),
    ('sas_attribute', r"(?i)(^|[^A-Za-z0-9_])(FORMAT|LABEL)\s*=", 'drop the attribute'),
    ('unquoted_var', r"(?i)CAST\s*\(\s*\{\{\s*var", 'quote the variable'),
)
LINT = [(rule, pattern) for rule, pattern, _ in LINT_TEXT]
LINT_SQL = " union all ".join(
    f"select script, line_no, line, '{rule}' as rule, 'error' as severity, '{advice}' as fix_suggestion from lines"
    f" where regexp_matches(line, '{pattern.replace(chr(39), chr(39) * 2).replace('{', '{{').replace('}', '}}')}')"
    for rule, pattern, advice in LINT_TEXT
)


@query(
    "script_lint",
    """select * from (with lines as (select script, unnest(string_split(text, chr(10))) as line,
         cast(generate_subscripts(string_split(text, chr(10)), 1) as int) as line_no from {scripts}) """
    + LINT_SQL
    + ")",
)
def script_lint(dom):
    return scripts.lint_scripts(dom.scripts)


# --------------------------------------------------------------------------- one pass over all of it
def _named_sql(table: str, key: str, where: str) -> str:
    return f"""select script, string_agg(if(schema_name <> '', schema_name || '.', '.') || table_name, ',' order by pattern, spot) as names
        from (select * from {table} where {where} qualify row_number() over (partition by script, {key} order by pattern, spot) = 1) group by script"""


L_CATALOG = {
    "cleaned": "select script, clean, flags from (" + _clean_sql() + ") union all select 'sas_' || script, clean, flags from (" + _sas_sql() + ")"
    + " union all select script, " + _strip("regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')") + ", '' from {catalog_scripts} where kind = 'model'",
    "to_all": _refs_sql(TARGET_RX, "cleaned", "clean"),
    "from_all": _refs_sql(SOURCE_RX, "cleaned", "clean"),
    "to_names": _named_sql("{to_all}", "lower(raw)", "true"),
    "from_names": _named_sql(
        "{from_all}",
        "lower(if(schema_name <> '', schema_name || '.' || table_name, table_name))",
        "table_name <> '' and lower(table_name) not in ('dual', 'select')"
        " and (script, lower(table_name)) not in (select (script, lower(table_name)) from {to_all})",
    ),
    "lint_names": "select script, string_agg(line_no || ':' || rule, ',' order by line_no, place) as hits from (with lines as (select script,"
    " unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from {catalog_scripts}) "
    + " union all ".join(
        f"select script, line_no, '{rule}' as rule, {place} as place from lines"
        f" where regexp_matches(line, '{pattern.replace(chr(39), chr(39) * 2).replace('{', '{{').replace('}', '}}')}')"
        for place, (rule, pattern) in enumerate(LINT)
    )
    + ") group by script",
    "lost": """select script, string_agg(ref, ',' order by ref) as names from (select distinct script, unnest(regexp_extract_all(text, 'ref\\([\\s]*[\\x22\\x27]([A-Za-z0-9_]+)[\\x22\\x27][\\s]*\\)', 1)) as ref
        from {catalog_scripts}) where ref not in (select script from {catalog_scripts}) group by script""",
}


@query(
    "script_catalog",
    """select c.script, c.clean, c.flags, coalesce(t.names, '') as targets, coalesce(f.names, '') as sources, coalesce(l.hits, '') as lint, coalesce(m.names, '') as missing
       from {cleaned} c left join {to_names} t using (script) left join {from_names} f using (script) left join {lint_names} l using (script) left join {lost} m using (script)""",
    **L_CATALOG,
)
def script_catalog(dom):
    out = scripts.script_catalog(dom.catalog_scripts).drop("removed")
    return out.withColumns({"flags": F.array_join("flags", "\n"), **{n: F.array_join(n, ",") for n in ("targets", "sources", "lint", "missing")}})


# --------------------------------------------------------------------------- model references
MODELS = """select 'm_' || cast(doc_id as varchar) as model, doc_id, text || ' select * from {{ ref(' || chr(39) || 'm_' || cast(doc_id * 2 as varchar)
      || chr(39) || ') }} join ref("x_' || cast(doc_id % 3 as varchar) || '")' as text from {documents}"""


@query(
    "missing_refs",
    """select r.model, r.ref, 'dangling_ref' as problem from (select distinct model, unnest(regexp_extract_all(text, 'ref\\([\\s]*[\\x22\\x27]([A-Za-z0-9_]+)[\\x22\\x27][\\s]*\\)', 1)) as ref
         from {models}) r where r.ref not in (select model from {models})
       union all select null, 'm_' || cast(doc_id + 5 as varchar), 'missing_model' from {documents} where 'm_' || cast(doc_id + 5 as varchar) not in (select model from {models})""",
    models=MODELS,
)
def missing_refs(dom):
    docs = dom.table("documents")
    ident = c("doc_id").cast("string")
    text = F.concat(
        "text", F.lit(" select * from {{ ref('m_"), (c("doc_id") * 2).cast("string"), F.lit("') }} join ref(\"x_"),
        (c("doc_id") % 3).cast("string"), F.lit('")'),
    )
    models = docs.select(F.concat(F.lit("m_"), ident).alias("model"), text.alias("text"))
    planned = docs.select(F.concat(F.lit("m_"), (c("doc_id") + 5).cast("string")).alias("model"))
    return scripts.missing_refs(models, planned)


# --------------------------------------------------------------------------- records
@query(
    "normalize_reviews",
    """select event_id, k in (0, 1) as is_valid, case k when 0 then 'complete' when 1 then 'complete' when 3 then 'complete_with_warnings'
           when 5 then 'complete_with_warnings' else 'needs_fix' end as status,
         case k when 0 then event_type when 1 then event_type when 4 then 'Reviewer response was malformed.' else 'Review completed.' end as summary,
         case k when 2 then 'm' || user_id || '.sql|' || event_type || '|error|;|note|warning|' when 3 then '|' || event_type || '|warning|'
           when 4 then '|Reviewer returned invalid response type.|error|' when 5 then 'c' || user_id || '|' || event_type || '|warning|fix' else '' end as issues
       from (select *, event_id % 6 as k from {events})""",
)
def normalize_reviews(dom):
    out = records.normalize_reviews(dom.review_json, "reply")
    flat = F.array_join(F.transform("issues", lambda i: F.concat_ws("|", i["file"], i["issue"], i["severity"], i["fix_suggestion"])), ";")
    return out.withColumn("issues", flat)


@query(
    "split_valid_good",
    """select event_id, 0 as pos, 'models/m' || user_id || '.sql' as path, 'select ' || event_id as content from {events} where event_id % 4 = 0
       union all select event_id, 0, 'macros/a' || user_id || '.sql', 'x' from {events} where event_id % 4 = 3
       union all select event_id, 1, 'p', null from {events} where event_id % 4 = 3""",
)
def split_valid_good(dom):
    return records.split_valid(dom.file_json, "reply", "models")[0]


@query(
    "split_valid_bad",
    """select event_id, 1 as pos, '"junk"' as item from {events} where event_id % 4 = 0
       union all select event_id, 0, '{{"path":"models/m' || user_id || '.sql"}}' from {events} where event_id % 4 = 1""",
)
def split_valid_bad(dom):
    return records.split_valid(dom.file_json, "reply", "models")[1]


@query(
    "normalize_tables",
    """select event_id, 'source_tables' as section, 0 as pos, if(event_id % 3 = 0, 'raw', '') as schema_name,
         if(event_id % 3 = 0, 'T', 'U') || user_id as table_name, '' as description, if(event_id % 3 = 0, 'direct', 'view') as access_method,
         if(event_id % 3 = 0, 'a,b', '') as columns_used from {events} where event_id % 3 <> 2""",
)
def normalize_tables(dom):
    out = records.normalize_tables(dom.analysis_json, "reply", "source_tables")
    return out.withColumn("columns_used", F.array_join("columns_used", ","))


@query(
    "normalize_models",
    """select event_id, 0 as pos, 'm' || user_id as name, 'silver' as layer, 'table' as materialization, 's1,' || event_type as sources, '' as depends_on, 'a b' as logic
         from {events} where event_id % 3 = 0
       union all select event_id, 2, 'n', 'notebook_stage', 'table', '', '', event_type from {events} where event_id % 3 = 0
       union all select event_id, 1, 'stage_2', 'notebook_stage', 'view', '', 'm' || user_id, '' from {events} where event_id % 3 = 1""",
)
def normalize_models(dom):
    out = records.normalize_models(dom.plan_json, "reply")
    return out.withColumns({"sources": F.array_join("sources", ","), "depends_on": F.array_join("depends_on", ",")})


@query(
    "normalize_cells",
    """select event_id, 0 as pos, 'markdown' as cell_type, 't' || event_id as source from {events} where event_id % 3 = 1
       union all select event_id, 1, 'code', event_type from {events} where event_id % 3 = 1
       union all select event_id, 0, 'code', 'u' || user_id from {events} where event_id % 3 = 2""",
)
def normalize_cells(dom):
    return records.normalize_cells(dom.plan_json, "reply")


@query(
    "normalize_outputs",
    """select event_id, 'output_tables' as section, 0 as pos, '' as schema_name, 'O' || user_id as table_name, event_type as description, 'direct' as access_method,
         '' as columns_used from {events} where event_id % 3 = 2
       union all select event_id, 'intermediate_tables', 0, 'work', 'W' || event_id, '', 'direct', '' from {events} where event_id % 3 = 2""",
)
def normalize_outputs(dom):
    outputs, inner = (records.normalize_tables(dom.plan_json, "reply", s) for s in ("output_tables", "intermediate_tables"))
    return outputs.unionByName(inner).withColumn("columns_used", F.array_join("columns_used", ","))


@query(
    "normalize_variables",
    """select event_id, 'macro_variables' as section, 0 as pos, 'v' as name, chr(39) || 'x' || chr(39) || ', ' || chr(39) || event_type || chr(39) as value from {events} where event_id % 3 = 0
       union all select event_id, 'macro_variables', 0, 'n', '5' from {events} where event_id % 3 = 2
       union all select event_id, 'macro_variables', 1, 'z', '' from {events} where event_id % 3 = 2""",
)
def normalize_variables(dom):
    return records.normalize_variables(dom.analysis_json, "reply")


@query(
    "normalize_blocks",
    """select event_id, 'transformation_blocks' as section, 0 as pos, 'block_1' as name, '' as type, 'o1' as output_table, '' as logic_summary from {events} where event_id % 3 = 1
       union all select event_id, 'transformation_blocks', 1, 'block_' || event_id, '', '', '' from {events} where event_id % 3 = 1
       union all select event_id, 'transformation_blocks', 0, event_type, 'join', 'out', '' from {events} where event_id % 3 = 2""",
)
def normalize_blocks(dom):
    return records.normalize_blocks(dom.analysis_json, "reply")


@query(
    "select_to_fix",
    """select f.path, f.content from (select 'models/m' || doc_id || '.sql' as path, text as content, doc_id from {documents}) f
       where exists (select 1 from {labels} l where l.toxic = 1 and l.doc_id = f.doc_id)""",
)
def select_to_fix(dom):
    docs = dom.table("documents")
    files = docs.select(F.concat(F.lit("models/m"), c("doc_id").cast("string"), F.lit(".sql")).alias("path"), c("text").alias("content"))
    ident = c("doc_id").cast("string")
    name = F.when(c("doc_id") % 2 == 0, F.concat(F.lit(" m"), ident)).otherwise(F.concat(F.lit("m"), ident, F.lit(".sql ")))
    issues = dom.table("labels").select(name.alias("file"), F.when(c("toxic") == 1, "error").otherwise("warning").alias("severity"))
    return records.select_to_fix(files, issues)


# --------------------------------------------------------------------------- mappings
EXACT = """
    select r.schema_name, r.table_name, r.column_name, t.target_schema, t.target_table, k.target_column from {column_refs} r
    left join (select lower(source_schema) as s, lower(source_table) as t, arg_min(target_schema, pos) as target_schema, arg_min(target_table, pos) as target_table
               from {mapping} group by 1, 2) t on lower(r.schema_name) = t.s and lower(r.table_name) = t.t
    left join (select lower(source_schema) as s, lower(source_table) as t, lower(source_column) as c, arg_max(target_column, pos) as target_column
               from {mapping} group by 1, 2, 3) k on lower(r.schema_name) = k.s and lower(r.table_name) = k.t and lower(r.column_name) = k.c"""


@query("resolve_exact", EXACT)
def resolve_exact(dom):
    return mapping_job.resolve_exact(dom.column_refs, dom.mapping)


def _intermediates(dom):
    return dom.column_refs.where(c("table_name").startswith("tmp_") & (F.length("table_name") == 5)).select("table_name").distinct()


def _work_refs(dom):
    """References as given, with the temporary tables in no schema."""
    schema = F.when(c("table_name").startswith("tmp_"), "").otherwise(c("schema_name"))
    return dom.column_refs.withColumn("schema_name", schema)


def _best(pairs: str, key: str, cutoff: float, name: str = "") -> str:
    """CTEs that end in ``best``: the best name of each word of ``pairs`` (key, word, name), with the ratio worked out block by block.

    A row of ``blocks`` is a stretch of the name and one of the word that are still to be compared, and the size of the block
    that was taken out between them. Blocks are looked for from the largest size down and from the front. Braces are doubled:
    the domain's SQL names its tables in single ones.
    """
    block = """list_filter(flatten(list_transform(range(least(length(a), length(b)), 0, -1),
        lambda k: list_transform(range(1, length(a) - k + 2), lambda i: {{'k': k, 'i': i}}))), lambda x: contains(b, substr(a, x.i, x.k)))[1]"""
    return f"""
      {name}pairs as ({pairs}),
      {name}near as (select * from {name}pairs where 2.0 * least(length(word), length(name)) / (length(word) + length(name)) >= {cutoff}),
      {name}blocks as (
        select {key}, word, name, name as a, word as b, 0::bigint as m from {name}near
        union all
        select {key}, word, name, side.a, side.b, side.m from (
          select {key}, word, name, unnest([
            {{{{'a': substr(a, 1, x.i - 1), 'b': substr(b, 1, strpos(b, substr(a, x.i, x.k)) - 1), 'm': x.k::bigint}}}},
            {{{{'a': substr(a, x.i + x.k), 'b': substr(b, strpos(b, substr(a, x.i, x.k)) + x.k), 'm': 0::bigint}}}}]) as side
          from (select {key}, word, name, a, b, {block} as x from {name}blocks where a <> '' and b <> '') where x is not null)),
      {name}scores as (select {key}, word, name, 2.0 * sum(m)::double / (length(word) + length(name)) as score from {name}blocks group by {key}, word, name),
      {name}best as (select {key}, word, (max({{{{'score': score, 'name': name}}}})).name as match from {name}scores where score >= {cutoff} group by {key}, word)"""


_TABLE_PAIRS = "select 1 as one, word, name from (WORDS), (select distinct lower(source_table) as name from {mapping})"

RESOLVED = f"""
  select * from (with recursive
    refs as (select if(table_name ^@ 'tmp_', '', schema_name) as schema_name, table_name, column_name from {{column_refs}}),
    kept as (select * from refs where not (lower(schema_name) in ('work', '') and length(table_name) = 5 and table_name ^@ 'tmp_')),
    maps as (select lower(source_schema) as map_schema, lower(source_table) as map_table, arg_min(target_schema, pos) as target_schema, arg_min(target_table, pos) as target_table
      from {{mapping}} group by 1, 2),
    wanted as (select distinct schema_name, table_name from kept),
    exact as (select w.*, m.* from wanted w left join maps m on lower(schema_name) = map_schema and lower(table_name) = map_table),
    {_best(_TABLE_PAIRS.replace("WORDS", "select distinct lower(table_name) as word from exact where target_table is null"), "one", 0.6)},
    smallest as (select match, min(map_schema) as map_schema from best join maps on map_table = match group by match),
    found as (
      select *, 'exact' as how from exact where target_table is not null
      union all
      select schema_name, table_name, m.map_schema, b.match, m.target_schema, m.target_table, if(b.match is null, 'unresolved', 'fuzzy')
      from (select schema_name, table_name from exact where target_table is null) left join best b on b.word = lower(table_name)
        left join smallest s on s.match = b.match left join maps m on m.map_schema = s.map_schema and m.map_table = s.match),
    cols as (select lower(source_schema) as map_schema, lower(source_table) as map_table, lower(source_column) as map_column, arg_max(target_column, pos) as target_column
      from {{mapping}} group by 1, 2, 3),
    rows as (select k.*, f.map_schema, f.map_table, f.target_schema, f.target_table, f.how, lower(k.column_name) as map_column, c.target_column
      from kept k join found f on f.schema_name = k.schema_name and f.table_name = k.table_name
      left join cols c on c.map_schema = f.map_schema and c.map_table = f.map_table and c.map_column = lower(k.column_name)),
    {_best('''select distinct r.map_schema, r.map_table, r.map_column as word, c.map_column as name from rows r
        join cols c on c.map_schema = r.map_schema and c.map_table = r.map_table where r.target_column is null''', "map_schema, map_table", 0.7, "column_")}
    select schema_name, table_name, column_name, coalesce(r.target_schema, schema_name) as target_schema, coalesce(r.target_table, table_name) as target_table,
      case when r.map_table is null then column_name else coalesce(r.target_column, c.target_column) end as target_column, how,
      case when r.target_column is not null then 'exact' when r.map_table is null then 'kept' when c.target_column is null then 'unresolved' else 'fuzzy' end as column_how,
      r.map_table, if(r.target_column is not null, r.map_column, b.match) as map_match
    from rows r left join column_best b on b.map_schema = r.map_schema and b.map_table = r.map_table and b.word = r.map_column and r.target_column is null
      left join cols c on c.map_schema = b.map_schema and c.map_table = b.map_table and c.map_column = b.match
    union all
    select schema_name, table_name, column_name, null, null, null, 'skipped', 'skipped', null, null from refs
    where lower(schema_name) in ('work', '') and length(table_name) = 5 and table_name ^@ 'tmp_')"""


@query("resolve_mappings", RESOLVED)
def resolve_mappings(dom):
    return mapping_job.resolve_mappings(_work_refs(dom), _intermediates(dom), dom.mapping)


@query(
    "resolution_report",
    """select schema_name, table_name, target_schema, target_table, how,
         coalesce(string_agg(column_name || '=' || target_column, ',' order by column_name, target_column)
           filter (where column_how in ('exact', 'fuzzy', 'kept')), '') as column_mappings,
         coalesce(string_agg(column_name, ',' order by column_name) filter (where column_how = 'unresolved'), '') as unresolved_columns
       from (select distinct schema_name, table_name, target_schema, target_table, how, column_name, target_column, column_how from {resolved})
       group by 1, 2, 3, 4, 5""",
    resolved=RESOLVED,
)
def resolution_report(dom):
    report = mapping_job.report_by_table(resolve_mappings(dom))
    pairs = F.transform(F.array_sort(F.map_entries("column_mappings")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return report.withColumns({"column_mappings": F.array_join(pairs, ","), "unresolved_columns": F.array_join("unresolved_columns", ",")})


DOTTED = "if(schema_name <> '', schema_name || '.' || table_name, table_name)"


@query(
    "resolution_notes",
    f"""select 'warning' as kind, 'Fuzzy matched table ''' || table_name || ''' -> ''' || map_table || '''' as note from {{resolved}} where how = 'fuzzy'
        union select 'warning', 'Fuzzy matched column ''' || column_name || ''' -> ''' || map_match || ''' in ' || table_name from {{resolved}} where column_how = 'fuzzy'
        union select 'unresolved_table', {DOTTED} from {{resolved}} where how = 'unresolved'
        union select 'warning', 'Some objects were not mapped explicitly. Original Oracle object names are retained for those objects.' from {{resolved}} where how = 'unresolved'
        union select 'skipped_table', {DOTTED} from {{resolved}} where how = 'skipped'""",
    resolved=RESOLVED,
)
def resolution_notes(dom):
    return mapping_job.resolution_notes(resolve_mappings(dom))


@query(
    "skipped_refs",
    """select '' as schema_name, table_name, column_name from {column_refs} where length(table_name) = 5 and table_name ^@ 'tmp_'""",
)
def skipped_refs(dom):
    return mapping_job.split_skipped(_work_refs(dom), _intermediates(dom))[1]


def _dictionary(dom):
    return dom.mapping.select("source_table").distinct()


@query(
    "fuzzy_match",
    f"""select * from (with recursive {_best(_TABLE_PAIRS.replace("WORDS", "select distinct lower(table_name) as word from {column_refs}"), "one", 0.6)}
        select table_name, match from (select distinct table_name from {{column_refs}}) left join best on word = lower(table_name))""",
)
def fuzzy_match(dom):
    return matching.fuzzy_match(dom.column_refs.select("table_name").distinct(), "table_name", _dictionary(dom), "source_table", 0.6)


_COLUMN_PAIRS = """select distinct r.t, lower(r.column_name) as word, m.name from (select distinct lower(table_name) as t, column_name from {column_refs}) r
    join (select distinct lower(source_table) as t, lower(source_column) as name from {mapping}) m on m.t = r.t"""


@query(
    "fuzzy_match_joined",
    f"""select * from (with recursive {_best(_COLUMN_PAIRS, "t", 0.7)}
        select r."table", column_name, match from (select distinct lower(table_name) as "table", column_name from {{column_refs}}) r
        left join best on best.t = r."table" and word = lower(column_name))""",
)
def fuzzy_match_joined(dom):
    """Column names against those of one source table each."""
    key = F.lower("table_name").alias("table")
    refs = dom.column_refs.select(key, "column_name").distinct()
    names = dom.mapping.select(F.lower("source_table").alias("table"), "source_column").distinct()
    return matching.fuzzy_match(refs, "column_name", names, "source_column", 0.7, ["table"])


@query(
    "sttm",
    """select target_schema, target_table, target_column, target_data_type, case when n = 0 then 'Derived' when n = 1 then 'Direct' else 'Multiple — see comments' end as transformation_rule,
         if(n = 1, s, '') as source_schema, if(n = 1, t, '') as source_table, if(n = 1, c, '') as source_column, if(n = 1, 'string', '') as source_data_type,
         if(n > 1, everything, '') as additional_comments
       from (select 'lake' as target_schema, p_type as target_table, 'k' || cast(p_size as varchar) as target_column, 'string' as target_data_type,
               count(distinct if(p_partkey % 3 <> 0, p_brand, null)) as n, min(if(p_partkey % 3 <> 0, 'dw', null)) as s, min(if(p_partkey % 3 <> 0, 'parts', null)) as t,
               min(if(p_partkey % 3 <> 0, p_brand, null)) as c,
               string_agg(distinct 'dw.parts.' || p_brand, '; ' order by 'dw.parts.' || p_brand) filter (where p_partkey % 3 <> 0) as everything
             from {part} group by 1, 2, 3, 4)""",
)
def sttm(dom):
    key = [F.lit("lake").alias("target_schema"), c("p_type").alias("target_table"), F.concat(F.lit("k"), c("p_size").cast("string")).alias("target_column")]
    part = dom.table("part")
    targets = part.select(*key, F.lit("string").alias("target_data_type")).distinct()
    src = [F.lit("dw").alias("source_schema"), F.lit("parts").alias("source_table"), c("p_brand").alias("source_column")]
    mapped = part.where(c("p_partkey") % 3 != 0)
    types = mapped.select(*src, F.lit("string").alias("source_data_type")).distinct()
    return mapping_job.sttm(mapped.select(*key, *src), targets, types)
