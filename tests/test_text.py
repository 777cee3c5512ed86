import random
import re
from difflib import SequenceMatcher, get_close_matches

import pytest
from pyspark.sql import functions as F

from claimspark.jobs import mapping as mapping_job
from claimspark.operators import matching, records, scripts

SCRIPT = """set define off;
SET SERVEROUTPUT ON ;

insert into s.t select a / b from a join "S"."T2" x, dual
  /
merge into `m`.u using q on 1=1;
update w set z=1;
execute immediate 'truncate table x';
delete from DEL where exists (select 1 from t);
select * from src.one join SRC.ONE join src.two



show errors;
"""


def python_clean(text):
    flags = []
    for pattern, label in scripts.PLSQL_WRAPPERS:
        flags += [f"[WRAPPER - {label}]: {m.strip()}" for m in re.findall(pattern, text)]
        text = re.sub(pattern, "", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip(), flags


def test_clean_plsql_equals_python_regex_and_is_idempotent(spark):
    texts = [SCRIPT, "a / b", "x \n / \n /", "", "café\nSET  define\toff ;\n\n\n\nend"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "script string, text string")
    got = {r["script"]: (r["clean"], list(r["flags"])) for r in scripts.clean_plsql(df).collect()}
    for i, t in enumerate(texts):
        assert got[str(i)] == python_clean(t)
    again = spark.createDataFrame([(k, v[0]) for k, v in got.items()], "script string, text string")
    assert {r["script"]: r["clean"] for r in scripts.clean_plsql(again).collect()} == {k: v[0] for k, v in got.items()}


def test_clean_sas(spark):
    text = "x 'rm a';\nproc append base=a data=b; run;\nTITLE1 'x';\n/* c\n c */\ndata a; set b; run;\nods html close;"
    row = scripts.clean_sas(spark.createDataFrame([("s", text)], "script string, text string")).first()
    assert row["clean"] == "data a; set b; run;"
    assert [f.split("]")[0] for f in row["flags"]] == [
        "[INGESTION - shell command", "[INGESTION - PROC APPEND", "[REPORTING - ODS HTML", "[REPORTING - TITLE statement",
    ]


def test_table_refs(spark):
    df = spark.createDataFrame([("p", SCRIPT)], "script string, text string")
    rows = {(r["role"], r["schema_name"], r["table_name"]) for r in scripts.extract_table_refs(df).collect()}
    targets = {("s", "t"), ("m", "u"), ("", "w"), ("", "x"), ("", "DEL")}
    assert {r[1:] for r in rows if r[0] == "target"} == targets
    assert {r[1:] for r in rows if r[0] == "source"} == {("", "a"), ("S", "T2"), ("src", "one"), ("src", "two")}


def test_lint(spark):
    df = spark.createDataFrame([("s", "x = NVL(a,b)\ndf.toPandas()\ncol::int\nok = coalesce(a)")], "script string, text string")
    assert [(r["line_no"], r["rule"]) for r in scripts.lint_scripts(df).orderBy("line_no").collect()] == [(1, "nvl"), (2, "collect"), (3, "double_colon_cast")]


def test_lint_literals_never_hide_a_match(spark):
    hits = {
        "nvl": "NVL (a)", "decode": "Decode(a", "rowid": "a.rowid", "forall": "FORALL i", "bulk_collect": "bulk  collect into", "execute_immediate": "EXECUTE immediate x",
        "exception_block": "exception WHEN others", "collect": "d.collect()", "quoted_table_name": "spark.table(`a`)", "date_trunc": "DATE_TRUNC('m', d)", "to_date": "To_Char(x)",
        "btrim": "btrim(x)", "double_colon_cast": "a::int", "qualify": "QUALIFY 1", "is_missing": "x is  missing", "cats_put": "CATS(a", "sas_attribute": "format = a",
        "unquoted_var": "cast({{ var(x) }} as date)",
    }
    assert set(hits) == {r[0] for r in scripts.LINT_RULES}
    df = spark.createDataFrame(list(hits.items()), "script string, text string")
    found = {(r["script"], r["rule"]) for r in scripts.lint_scripts(df).collect()}
    assert {(k, k) for k in hits} <= found


def test_missing_refs(spark):
    models = spark.createDataFrame([("a", "{{ ref('b') }} {{ ref(\"zz\") }}"), ("b", "")], "model string, text string")
    planned = spark.createDataFrame([("a",), ("lost",)], "model string")
    got = {(r["ref"], r["problem"]) for r in scripts.missing_refs(models, planned).collect()}
    assert got == {("zz", "dangling_ref"), ("lost", "missing_model")}


NAMES = ["pharmacy_claims", "medical_claims", "rx_claims", "member", "members", "ndc_master", "ndc_price", "aa", "bb", "abc", "cab"]


@pytest.mark.parametrize("cutoff", [0.6, 0.7])
def test_fuzzy_match_equals_difflib(spark, cutoff):
    rng = random.Random(11)
    words = ["pharm_claims", "zzz", "Member", "ndc_mastr", ""] + ["".join(rng.choice("abcdm_") for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    df = spark.createDataFrame([(w,) for w in sorted(set(words))], "w string")
    names = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for r in matching.fuzzy_match(df, "w", names, "n", cutoff).collect():
        want = get_close_matches(r["w"].lower(), NAMES, n=1, cutoff=cutoff)
        assert r["match"] == (want[0] if want else None), r["w"]


def test_fuzzy_match_within_groups_scores_few_pairs(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abcdefghijklmnop_") for _ in range(rng.randrange(4, 14))) for _ in range(120)})
    words = [n[:-1] + "z" for n in names[:60]] + ["qqqq"]
    left = spark.createDataFrame([(i % 2, w) for i, w in enumerate(words)], "g int, w string")
    right = spark.createDataFrame([(i % 2, n) for i, n in enumerate(names)], "g int, n string")
    got = {(r["g"], r["w"]): r["match"] for r in matching.fuzzy_match(left, "w", right, "n", 0.7, ["g"]).collect()}
    for i, w in enumerate(words):
        want = get_close_matches(w, [n for k, n in enumerate(names) if k % 2 == i % 2], n=1, cutoff=0.7)
        assert got[i % 2, w] == (want[0] if want else None)
    pairs = matching.candidate_pairs(left.selectExpr("g", "w as word"), right.selectExpr("g", "n as name"), 0.7, ["g"])
    assert pairs.count() == pairs.distinct().count() < 0.1 * len(words) * len(names)
    assert matching.scored_pairs(pairs, ["g"]).count() < 0.02 * len(words) * len(names)


def test_blocks_equal_the_library(spark):
    rng = random.Random(7)
    text = lambda k, n: "".join(rng.choice(k) for _ in range(rng.randint(0, n)))
    pairs = [(text("ab", 9), text("ab", 9)) for _ in range(400)] + [(text("abcdeé_", 40), text("abcdeé_", 40)) for _ in range(400)]
    pairs += [("", ""), ("a", ""), ("x" * 300, "x" * 250 + "y"), (text("abc ", 260), text("abc ", 260) + "a" * 200)]
    want = [sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) for a, b in pairs]
    assert matching.matched_characters([a for a, _ in pairs], [b for _, b in pairs]).tolist() == want
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r["s"] for r in df.select(matching.gestalt_ratio("a", "b").alias("s")).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_short_names(spark):
    words = ["a", "b", "ab", "ba", "aa", "abc", "é", ""]
    left = spark.createDataFrame([(w,) for w in words], "w string")
    for cutoff in (0.5, 0.6, 0.9):
        for r in matching.fuzzy_match(left, "w", left.withColumnRenamed("w", "n"), "n", cutoff).collect():
            scores = [(SequenceMatcher(None, n, r["w"]).ratio(), n) for n in words if r["w"] and n]
            best = max((s for s in scores if s[0] >= cutoff), default=None)
            assert r["match"] == (best[1] if best else None), (r["w"], cutoff)


def test_gestalt_ratio(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("A", "a"), (None, "x")], "a string, b string")
    got = [r["s"] for r in df.select(matching.gestalt_ratio("a", "b").alias("s")).collect()]
    assert got[:2] == [SequenceMatcher(None, "abcd", "bcde").ratio(), 1.0] and got[2] is None


def test_resolution_report(spark):
    mapping = spark.createDataFrame(
        [
            ("dw", "pharmacy_claims", "ndc", "raw", "rx_claims", "old", 0), ("dw", "pharmacy_claims", "NDC", "raw", "rx_claims", "ndc_code", 1),
            ("dw", "pharmacy_claims", "member_id", "raw", "other", "mbr_id", 2),
        ],
        "source_schema string, source_table string, source_column string, target_schema string, target_table string, target_column string, pos long",
    )
    refs = spark.createDataFrame(
        [("DW", "Pharmacy_Claims", "NDC"), ("x", "pharm_claims", "member_ids"), ("x", "pharm_claims", "qq"), ("x", "zzz", "a"), ("", "tmp", "a")],
        "schema_name string, table_name string, column_name string",
    )
    made = spark.createDataFrame([("TMP",)], "table_name string")
    got = {(r["table_name"], r["column_name"]): (r["target_table"], r["target_column"], r["how"], r["column_how"]) for r in mapping_job.resolve_mappings(refs, made, mapping).collect()}
    assert got == {
        ("Pharmacy_Claims", "NDC"): ("rx_claims", "ndc_code", "exact", "exact"),
        ("pharm_claims", "member_ids"): ("rx_claims", "mbr_id", "fuzzy", "fuzzy"),
        ("pharm_claims", "qq"): ("rx_claims", None, "fuzzy", "unresolved"),
        ("zzz", "a"): ("zzz", "a", "unresolved", "kept"),
        ("tmp", "a"): (None, None, "skipped", "skipped"),
    }


def test_reviews(spark):
    replies = ['{"overall_verdict":"Pass"}', '{"issues":["x"]}', "[1]", '{"is_valid":false,"issues":[{"issue":"b","severity":"ERROR"},5,null]}', "{broken"]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, j string")
    got = [(r["is_valid"], len(r["issues"]), r["status"]) for r in records.normalize_reviews(df, "j").orderBy("i").collect()]
    assert got == [(True, 0, "complete"), (False, 1, "complete_with_warnings"), (False, 1, "needs_fix"), (False, 1, "needs_fix"), (False, 1, "needs_fix")]


def test_plan_models_and_cells(spark):
    plan = '{"models":[{"logic":["a",null,"b"]},"junk",{"model_name":"m","sources":["s",1]}],"notebook_cells":[{"source":"x","cell_type":"sql"},{"cell_type":"code"}]}'
    df = spark.createDataFrame([(1, plan)], "i int, j string")
    models = records.normalize_models(df, "j").orderBy("pos").collect()
    assert [(r["name"], r["logic"], r["layer"], r["sources"]) for r in models] == [("stage_1", "a b", "notebook_stage", []), ("m", "", "notebook_stage", ["s", "1"])]
    assert [(r["cell_type"], r["source"]) for r in records.normalize_cells(df, "j").collect()] == [("code", "x")]


def test_select_to_fix_falls_back_to_all(spark):
    files = spark.createDataFrame([("models/a.sql", "1"), ("models/b.sql", "2")], "path string, content string")
    hit = spark.createDataFrame([("a", "error"), ("b", "warning")], "file string, severity string")
    none = spark.createDataFrame([("zz", "error")], "file string, severity string")
    assert [r["path"] for r in records.select_to_fix(files, hit).collect()] == ["models/a.sql"]
    assert records.select_to_fix(files, none).count() == 2


def test_select_to_fix_cells_and_project_files(spark):
    names = ["notebook/cell_1.py", "notebook/cell_2.py", "models/sources.yml", "models/schema.yml", "dbt_project.yml", "models/a.sql"]
    files = spark.createDataFrame([(n, "" if n == "models/schema.yml" else "x") for n in names], "path string, content string")

    def picked(*rows):
        issues = spark.createDataFrame(rows, "file string, severity string, issue string")
        return {r["path"] for r in records.select_to_fix(files, issues).collect()}

    assert picked(("cell_2", "error", "")) == {"notebook/cell_2.py"} and picked(("cell_2.py", "error", "")) == set(names)
    assert picked(("a.sql", "error", "no Sources given"), ("x", "warning", "dbt_project")) == {"models/a.sql", "models/sources.yml"}
    assert picked(("dbt_project.yml", "error", "bad schema")) == {"dbt_project.yml"}


def test_resolution_notes(spark):
    cols = "schema_name string, table_name string, column_name string, how string, column_how string, map_table string, map_match string"
    rows = [("S", "t1", "a", "fuzzy", "exact", "t_1", "a"), ("S", "t1", "b", "fuzzy", "fuzzy", "t_1", "bb"), ("", "t2", "a", "unresolved", "kept", None, None), ("work", "t3", "a", "skipped", "skipped", None, None)]
    got = {(r["kind"], r["note"]) for r in mapping_job.resolution_notes(spark.createDataFrame(rows, cols)).collect()}
    assert got == {
        ("warning", "Fuzzy matched table 't1' -> 't_1'"), ("warning", "Fuzzy matched column 'b' -> 'bb' in t1"), ("unresolved_table", "t2"), ("skipped_table", "work.t3"),
        ("warning", "Some objects were not mapped explicitly. Original Oracle object names are retained for those objects."),
    }


def test_sttm(spark):
    mapping = spark.createDataFrame([("s", "t", "a", "l", "x", "one"), ("s", "t", "b", "l", "x", "two"), ("s", "t", "c", "l", "x", "two")], "source_schema string, source_table string, source_column string, target_schema string, target_table string, target_column string")
    targets = spark.createDataFrame([("l", "x", n, "string") for n in ("one", "two", "new")], "target_schema string, target_table string, target_column string, target_data_type string")
    got = {r["target_column"]: (r["transformation_rule"], r["source_column"], r["additional_comments"]) for r in mapping_job.sttm(mapping, targets).collect()}
    assert got == {"one": ("Direct", "a", ""), "two": ("Multiple — see comments", "", "s.t.b; s.t.c"), "new": ("Derived", "", "")}


def test_apply_mapping(spark):
    out, unmapped = mapping_job.apply_mapping(spark.createDataFrame([(1, 2)], "NDC int, q int"), {"ndc": "ndc_code"})
    assert out.columns == ["ndc_code", "q"] and unmapped == ["q"]
    assert out.select(F.col("ndc_code")).first()[0] == 1


def test_catalog_of_mixed_dialects(spark):
    rows = [
        ("p", "plsql", "set define off;\nINSERT INTO a.t SELECT nvl(x) FROM b\n/* kept */"),
        ("s", "sas", "proc export data=a; run;\n/* gone */ select 1 from lib.x;\nset define off;"),
        ("m", "Model", "select * from ref('p') join ref(\"lost\") join ref('m') join ref('also_lost')\n\n\n\nx"),
        ("n", None, "show errors;\nupdate q set z = 1"), ("e", "sas", None),
    ]
    out = {r["script"]: r for r in scripts.script_catalog(spark.createDataFrame(rows, "script string, kind string, text string")).collect()}
    assert set(out) == {"p", "s", "m", "n", "e"}
    assert "set define" not in out["p"]["clean"] and "kept" in out["p"]["clean"] and out["p"]["targets"] == ["a.t"] and out["p"]["sources"] == [".b"]
    assert "export" not in out["s"]["clean"] and "gone" not in out["s"]["clean"] and "set define off" in out["s"]["clean"] and out["s"]["sources"] == ["lib.x"]
    assert out["m"]["missing"] == ["also_lost", "lost"] and out["p"]["missing"] == [] and out["m"]["clean"].endswith("\n\nx")
    assert len(out["n"]["flags"]) == 1 and out["n"]["targets"] == [".q"]
    plain = spark.createDataFrame([(r[0], r[2]) for r in rows if r[1] == "plsql"], "script string, text string")
    assert scripts.script_catalog(plain).first() == out["p"]
