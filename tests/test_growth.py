"""Plans and steps that must hold when the tables grow."""

import re

import __spark_entry__ as entry_point
from claimspark.jobs import hcg
from claimspark.operators import joins, reshape, scripts
from claimspark.plans import domain

FOLDER = "/root/testdata/sf0.001"


def broadcast_tables(df):
    """Base tables read below a broadcast, as the plan states them."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:+\-*(\d)]*", line)[0]) for line in lines]
    found = set()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                found |= set(re.findall(r"/(\w+)\.parquet", lines[j]))
    return found


def test_drug_master_broadcasts_code_tables_only(spark):
    # part and lineitem grow with the drugs; compressed, they look small enough to broadcast
    assert broadcast_tables(entry_point.queries()["drug_master"](spark, FOLDER)) <= {"nation", "region"}


def test_each_block_pattern_is_searched_once(spark):
    # inside a lambda or a condition an expression is worked out anew, and these are regexes over whole texts
    rows = spark.createDataFrame([("a", "x 'ls';\nproc append base=a data=b; run;\nkept")], "script string, text string")
    out = scripts.clean_sas(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == len(scripts.SAS_INGESTION) + len(scripts.SAS_REPORTING)
    row = out.first()
    assert row["clean"] == "kept" and [f.split("]")[0] for f in row["flags"]] == ["[INGESTION - shell command", "[INGESTION - PROC APPEND"]


def test_names_behind_letters_that_equal_ascii_ones_in_upper_case(spark):
    rows = spark.createDataFrame([("a", "ınſert into s.t select 1 from r joın q"), ("b", None)], "script string, text string")
    got = {(r["script"], r["role"], r["schema_name"], r["table_name"]) for r in scripts.extract_table_refs(rows).collect()}
    assert got == {("a", "target", "s", "t"), ("a", "source", "", "r"), ("a", "source", "", "q")}


def test_codes_by_slot_are_no_columns_before_the_last_step(spark):
    # 90 columns for each claim went through three shuffles and out of compiled code
    rows = [("P", "L", "M", "1", "A", "DXICD10", "Y", "2"), ("P", "L", "M", "1", "B", "DXICD10", "N", "2"), ("P", "L", "M", "1", "C", "DXICD9", None, "x"), ("P", "L", "M", "1", "E", "PXICD10", None, "31")]
    facts = spark.createDataFrame(rows, [*hcg.CLAIM_KEY, "code", "code_desc", "poa", "prmry_ind"])
    got = {r["icd_version"]: {k: tuple(v) for k, v in r["dx"].items()} for r in reshape.dx_slots(facts, hcg.CLAIM_SORT).collect()}
    assert got == {"10": {2: ("B", "Y")}, "09": {}}
    assert [r["px"][31]["code"] for r in reshape.px_slots(facts, hcg.CLAIM_SORT).collect()] == ["E"]


def test_lines_of_a_claim_are_sorted_by_what_tells_claims_apart(spark):
    # Spark compares the first bytes of the first column; by payer first, all other columns are compared again and again
    plan = entry_point.queries()["claim_line_rank"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[claim_id#", plan)


def plan_lines(spark, name):
    """The plan as it is where no table is small enough to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return entry_point.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set(key, old)


def test_distinct_visits_are_found_where_they_lie(spark):
    # a shuffle by all 46 columns
    assert not [line for line in plan_lines(spark, "unified_visits") if "Exchange hashpartitioning" in line and "more fields" in line]


def test_mart_ranks_rows_where_the_joins_by_member_left_them(spark):
    lines = plan_lines(spark, "patient_seen_mart")
    first = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert any("Window" in line for line in lines[:first])
    assert not [line for line in lines[:first] if "Exchange" in line]


def test_month_is_compared_within_the_member(spark):
    left = spark.createDataFrame([("a", "1", 1), ("a", None, 2), (None, "1", 3), ("b", "9", 4)], "k string, m string, id int")
    right = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", "2", "z"), (None, "1", "n"), ("a", None, "o")], "k string, _m string, v string")
    got = sorted((r["id"], r["v"] or "") for r in joins.within_key(left, right, ["k"], "m", "_m").collect())
    assert got == [(1, "x"), (1, "y"), (2, ""), (3, ""), (4, "")]


def shuffles_above(lines, table):
    """How often the rows of a base table's scan are shuffled on their way to the result, for each scan."""
    depth = [len(re.match(r"[\s:+\-*(\d)]*", line)[0]) for line in lines]
    counts = []
    for i, line in enumerate(lines):
        if f"/{table}.parquet" in line:
            at, n = depth[i], 0
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at, n = depth[j], n + ("Exchange hashpartitioning" in lines[j])
            counts.append(n)
    return counts


def test_lines_move_once_and_rank_where_they_lie_by_claim(spark):
    # they moved for their orders, for the members and, at their widest, by claim
    assert shuffles_above(plan_lines(spark, "claim_line_rank"), "lineitem") == [1]


def test_lines_by_claim_are_the_rows_of_the_checked_join(spark):
    dom = domain.Domain(spark, FOLDER)
    for name in ("fact_service", "fact_dxpx"):
        sql = domain.TABLES[name]
        checked = spark.sql(sql, **{r: dom.table(r) for r in domain._refs(sql)})
        assert checked.columns == dom.table(name).columns
        assert checked.exceptAll(dom.table(name)).isEmpty() and dom.table(name).exceptAll(checked).isEmpty()


def test_lines_move_again_for_their_headers_only_when_ranked(spark):
    # for the headers a line takes its key, rank and amount along; by claim it took all the columns of the order
    lines = plan_lines(spark, "allocate_header_paid")
    assert shuffles_above(lines, "lineitem") == [2]
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert "Exchange hashpartitioning(claim_id" in "".join(lines[:window])
