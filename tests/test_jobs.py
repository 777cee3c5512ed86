import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from claimspark.jobs import drug_master, glp1, hcg, patient_seen, unified_member, visits
from claimspark.operators import ranking, reshape
from claimspark.plans.domain import Domain
from claimspark.plans.q_visits import _tables

c = F.col
D = Decimal
LINES = (
    "payer string, lob string, member_id string, claim_id string, service_dt date, service_code string, revenue_code string, cpt_modifier1 string,"
    " cpt_modifier2 string, place_of_service string, cap_claim_ind string, allowed_amount decimal(18,2), paid_amount decimal(18,2),"
    " unit_count decimal(18,2), include_flag string"
)


def line(payer, lob, member, claim, revenue, paid=5):
    return (payer, lob, member, claim, dt.date(2024, 1, 1), "S", revenue, None, None, "1", "Y", D(9), D(paid), D(1), "Y")


def test_header_total_goes_to_the_first_ranked_line(spark):
    rows = [line("MSSP", "MA", "m", "c", r) for r in ("450", "120", None)] + [line("AETNA", "MA", "m", "d", "1")] + [line("MSSP", "MA", "0" * 20, "e", "1")]
    ranked = hcg.rank_claim_lines(spark.createDataFrame(rows, LINES))
    header = spark.createDataFrame([("c", "Facility", D(100)), ("d", "Facility", D(70))], "claim_id string, claim_type string, tcc_paid decimal(18,2)")
    out = ranked.join(header, "claim_id", "left").select(
        "claim_id", "revenue_code", hcg.allocate_header_paid(c("payer"), c("claim_type"), c("rn"), c("tcc_paid"), c("paid_amount")).alias("paid")
    )
    got = {(r["claim_id"], r["revenue_code"]): int(r["paid"]) for r in out.collect()}
    assert got == {("c", "450"): 100, ("c", "120"): 0, ("c", None): 0, ("d", "1"): 5}


def test_sequence_numbers_are_those_of_a_window(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    names = (*hcg.FAMILY_TABLES, "nppes", "taxonomy_xwalk", "specialty_xwalk")
    rows = hcg.hcg_claims({n: dom.table(n) for n in names}, "2024-01-20").select("payer", "srclob", "sequencenumber", "claimid", "memberid").collect()
    groups = {}
    for r in rows:
        groups.setdefault((r["payer"], r["srclob"]), []).append((r["sequencenumber"], r["memberid"], r["claimid"]))
    for got in groups.values():
        got.sort()
        assert [n for n, _, _ in got] == list(range(1, len(got) + 1))
        assert [x[1:] for x in got] == sorted(x[1:] for x in got)


def test_lines_without_a_claim_id(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    names = (*hcg.FAMILY_TABLES, "nppes", "taxonomy_xwalk", "specialty_xwalk")
    src = {n: dom.table(n) for n in names}
    nameless = F.when(F.pmod(F.xxhash64("claim_id"), F.lit(5)) > 0, c("claim_id"))
    for n in hcg.CLAIM_FACTS:
        src[n] = src[n].withColumn("claim_id", nameless)
    rows = hcg.hcg_claims(hcg.bucket_facts(src, 3), "2024-01-20").select("payer", "srclob", "sequencenumber", "claimid", "memberid", "dob", "drg").collect()
    lines = src["fact_service"].where(c("member_id") != "00000000000000000000")
    assert {r["claimid"] is None for r in rows} == {True, False} and len(rows) >= lines.count()
    assert all(r["drg"] is None for r in rows if r["claimid"] is None) and any(r["dob"] for r in rows if r["claimid"] is None)
    groups = {}
    for r in rows:
        groups.setdefault((r["payer"], r["srclob"]), []).append((r["sequencenumber"], r["memberid"], r["claimid"] is None, r["claimid"] or ""))
    for got in groups.values():
        got.sort()
        assert [x[0] for x in got] == list(range(1, len(got) + 1)) and [x[1:] for x in got] == sorted(x[1:] for x in got)


def test_bucketed_facts_meet_without_a_shuffle(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    names = (*hcg.FAMILY_TABLES, "nppes", "taxonomy_xwalk", "specialty_xwalk")
    src = hcg.bucket_facts({n: dom.table(n) for n in names}, 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hcg.rank_claim_lines(src["fact_service"]).join(src["claim_header"], hcg.CLAIM_KEY, "left")
        joined = joined.join(reshape.dx_wide(src["fact_dxpx"], hcg.CLAIM_KEY), hcg.CLAIM_KEY, "left").join(reshape.px_wide(src["fact_dxpx"], hcg.CLAIM_KEY), hcg.CLAIM_KEY, "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # nor does the extract itself move a row by the claim key
    plan = hcg.hcg_claims(src, "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "claim_id" in line]


def test_running_starts(spark):
    rows = [(g, i, (7 * i) % 5) for g in ("a", "b", None) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i int, n int")
    out = ranking.running_starts(df, ["g"], [c("i").asc()], "n", "start", 6).collect()
    assert {(r["g"], r["i"]): r["start"] for r in out} == {(g, i): sum((7 * k) % 5 for k in range(i)) for g, i, _ in rows}


def test_control_picks_the_family(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    names = (*hcg.FAMILY_TABLES, "nppes", "taxonomy_xwalk", "specialty_xwalk")
    x = {n: dom.table(n) for n in names}
    y = {**x, "fact_service": x["fact_service"].withColumn("service_code", F.lit("FROM_Y"))}
    out = hcg.load_hcg(dom.control, x, y, "2024-01-20")
    got = {r["payer"]: r["n"] for r in out.groupBy("payer").agg(F.max(c("hcpcs") == "FROM_Y").alias("n")).collect()}
    assert got["HNACO"] is True and set(v for k, v in got.items() if k != "HNACO") == {False}
    assert out.where((c("payer") == "AETNA") & (c("srclob") == "MA")).isEmpty()
    assert len(out.columns) == 157


def test_glp1(spark):
    rx = spark.createDataFrame(
        [("a", "0169-7501-12", dt.date(2023, 1, 1)), ("b", "0169-3935-11", dt.date(2023, 12, 31)), ("c", "0169-3935-11", dt.date(2023, 5, 1)),
         ("d", "0169-3935-11", dt.date(2024, 1, 1)), ("e", "x", dt.date(2023, 5, 1)), ("f", "00024-0590-30", dt.date(2023, 5, 1))],
        "member_id string, ndc string, fill_date date",
    )
    med = spark.createDataFrame([("a", "E11.9"), ("b", "E08"), ("b", "E13.1"), ("c", "E12.0"), ("f", None)], "member_id string, dx_code string")
    got = {r["member_id"]: r["final_category"] for r in glp1.classify_glp1(rx, med, "2023-01-01", "2023-12-31").collect()}
    assert got == {"a": "Weight Loss", "b": "Diabetes Management", "c": "Likely Weight Loss", "f": "Likely Weight Loss"}


def test_facility_switch_and_member_months(spark):
    df = spark.createDataFrame(
        [("Facility", "Hospital", "1"), ("Professional", "Hospital", "1"), ("Facility", "Clinic", "1013360528"), ("Facility", "Clinic", "1")],
        "claim_type string, claim_place_of_service string, servicing_npi string",
    ).withColumns({"attending_npi": F.lit("att"), "servicing_tin": F.lit("st"), "attending_tin": F.lit("at")})
    assert [r["servicing_pcp_npi"] for r in visits.servicing_provider(df).collect()] == ["att", "1", "att", "1"]
    months = spark.createDataFrame(
        [("p", "l", "m", "2024-01", dt.date(2024, 1, 1), v, "n", "t") for v in (None, 0, 1)],
        "payer string, lob string, member_id string, effper string, effper_dt date, member_months int, attributed_pcp_npi string, attributed_pcp_tax_id string",
    )
    assert [r["member_months"] for r in visits.member_months(months).collect()] == [1]


VISIT = "source string, pc_visit_los_code_yn int, pc_visit_cmplt_close_yn int, pc_visit_prov_type_yn int, servicing_pcp_practice string, servicing_pcp_npi string, p string, pod string, n string"


def test_attributed_match_three_valued_logic(spark):
    rows = [
        ("CLAIMSTAR", 1, 1, None, "Prac", "1", "PRAC", None, "2"),  # pod unknown, NPI different
        ("CLAIMSTAR", 1, 1, None, "Prac", "1", "other", "x", "1"),  # NPI alone
        ("CLAIMSTAR", 1, 1, None, "Prac", "1", "PRAC", "80 - Requires Investigation", "2"),
        ("MV_DM_PATIENT_ACCESS", 1, 1, 0, "Prac", "1", "Prac", "x", "1"),
        ("MV_DM_PATIENT_ACCESS", 1, 1, 1, "Prac", "1", "Prac", "x", "9"),
    ]
    df = spark.createDataFrame(rows, VISIT)
    assert [r["m"] for r in df.select(patient_seen.attributed_match(c("p"), c("pod"), c("n")).alias("m")).collect()] == [0, 1, 0, 0, 1]


def test_exclusion_precedence(spark):
    names = ", ".join(f"{n} int" for n in patient_seen.CHECK_COLS)
    df = spark.createDataFrame([("CLAIMSTAR", 1, 1, 0, None, 1), ("CLAIMSTAR", 1, 1, None, None, 1)], f"source string, {names}")
    rows = patient_seen.exclusion_flags(df).collect()
    assert [r["excluded_epic_prov_type"] for r in rows] == [1, None]
    assert [r["excluded_vis_compl_clsd"] for r in rows] == [1, 1]


def test_dedup_null_wins_first_pass(spark):
    cols = (
        "member_id string, lob string, payer string, date_of_service date, servicing_pcp_npi string, encounter_id string, any_match int,"
        " pc_visit_all_match_yn int, awv_indicator string, source string, pc_visit_cmplt_close_yn int, proc_code string, proc_code_desc string,"
        " enc_type_pos string, visit_status_type string, pri_mrn string"
    )
    day = dt.date(2024, 1, 1)
    rows = [("m", "l", "p", day, "n", "e", 1, v, "Y", "CLAIMSTAR", 1, None, None, None, None, None) for v in (1, None)]
    assert [r["pc_visit_all_match_yn"] for r in patient_seen.dedup_encounters(spark.createDataFrame(rows, cols)).collect()] == [None]


def test_rolling_bounds(spark):
    assert unified_member.rolling_bounds(None, dt.date(2025, 3, 10), True) == (dt.date(2024, 3, 1), dt.date(2025, 2, 28))
    assert unified_member.rolling_bounds(None, dt.date(2024, 3, 10), True)[0] == dt.date(2023, 3, 2)
    assert unified_member.rolling_bounds(None, dt.date(2024, 3, 10)) == (dt.date(2023, 3, 1), dt.date(2024, 2, 29))
    previous = spark.createDataFrame(
        [("Rolling 12", dt.date(2024, 1, 1), dt.date(2025, 1, 20)), ("Rolling 12", dt.date(2024, 12, 1), dt.date(2025, 1, 20)), ("MSSP", dt.date(2020, 1, 1), dt.date(2025, 1, 20))],
        "reporting_window string, reporting_date date, load_dt date",
    )
    assert unified_member.rolling_bounds(previous, dt.date(2025, 2, 3)) == (dt.date(2024, 2, 1), dt.date(2025, 1, 31))
    assert unified_member.rolling_bounds(previous, dt.date(2025, 1, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_running_counts(spark):
    months = [dt.date(2024, m, 1) for m in (1, 2, 3)]
    rows = [(months[0], 1), (months[1], 2), (months[2], None)]
    df = spark.createDataFrame(rows, "month date, count_pcp_npi_visits long").withColumn("k", F.lit(1))
    for n in (*unified_member.FLAGS, *unified_member.COUNTS):
        if n != "count_pcp_npi_visits":
            df = df.withColumn(n, F.lit(0))
    out = unified_member.running_visit_measures(df, ["k"], "month").orderBy("month")
    assert [r["count_pcp_npi_visits"] for r in out.collect()] == [1, 3, 3]


def test_report_has_one_row_per_member_and_month(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    t = _tables(dom)
    report = unified_member.member_reporting(t, visits.legacy_visits(visits.unified_visits(t, "2024-01-20")), dt.date(2024, 1, 20)).cache()
    key = ["reporting_month", "reporting_date", "reporting_period", "reporting_window", "payer", "lob", "member_id"]
    assert report.count() == report.select(*key).distinct().count() > 0
    assert {r[0] for r in report.select("reporting_window").distinct().collect()} == {"Rolling 12", "Calendar Year", "MSSP"}


def test_price_label(spark):
    df = spark.createDataFrame([("n", t, D(1), "20240101") for t in ("24", "25", "09")], "ndc string, npt_type string, npt_pricex decimal(18,5), npt_datec string")
    assert sorted((r["npt_type"], r["nadac_type"]) for r in drug_master.nadac_prices(df).collect()) == [("24", "Brand"), ("25", "Generic")]
