import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import aggregate, joins, project, ranking, reshape, upsert

c = F.col


def test_number_rows_matches_a_plain_ranking_with_a_hot_group_and_copies(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.randrange(20)) for _ in range(3000)] + [("hot", 5)] * 1500 + [(None, 1)] * 10
    df = spark.createDataFrame(rows, "g string, v int")
    got = ranking.number_rows(df, ["g"], [c("v").asc()], "n", partitions=6).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r["g"], []).append((r["n"], r["v"]))
    assert sum(len(v) for v in by_group.values()) == len(rows)
    for g, pairs in by_group.items():
        pairs.sort()
        assert [n for n, _ in pairs] == list(range(1, len(pairs) + 1))
        assert [v for _, v in pairs] == sorted(v for gg, v in rows if gg == g)


def test_rank_rows_and_number_rows_agree(spark):
    rows = [("hot", i) for i in range(400)] + [("cold", i) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, v int")
    order = [c("v").desc()]
    window = sorted(map(tuple, ranking.rank_rows(df, ["g"], order).collect()))
    mixed = sorted(map(tuple, ranking.number_rows(df, ["g"], order, "rn").collect()))
    assert window == mixed


def test_keep_first_is_pruned_before_the_shuffle(spark):
    df = spark.range(100).select((c("id") % 3).alias("g"), "id")
    out = ranking.keep_first(df, ["g"], [c("id").desc()])
    assert sorted(r["id"] for r in out.collect()) == [97, 98, 99]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.rindex("Partial") and "WindowGroupLimit" in plan


def test_latest_by_puts_null_first(spark):
    df = spark.createDataFrame([("a", "2024-01"), ("a", None), ("b", "2023-01"), ("b", "2024-02")], "k string, p string")
    assert sorted((r["k"], r["p"]) for r in ranking.latest_by(df, ["k"], "p").collect()) == [("a", None), ("b", "2024-02")]


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_range_join_both_routes(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    rng = random.Random(3)
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(500)) for _ in range(300)]
    periods = [("a", dt.date(2023, 1, 15), dt.date(2023, 6, 3)), ("b", dt.date(2023, 3, 1), dt.date(2024, 2, 29)), ("c", dt.date(2024, 2, 1), dt.date(2024, 1, 1))]
    df = spark.createDataFrame(list(enumerate(days)), "i int, d date")
    per = spark.createDataFrame(periods, "p string, start_dt date, end_dt date")
    got = sorted((r["i"], r["p"]) for r in joins.range_join(df, per, "d").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted((i, p) for i, d in enumerate(days) for p, s, e in periods if s <= d <= e)


def test_null_tolerant_join(spark):
    left = spark.createDataFrame([("m", None, None), ("m", "x", "p")], "member string, mrn string, practice string")
    right = spark.createDataFrame([("m", None, None, 1), ("m", "x", "p", 2)], "member string, mrn string, practice string, v int")
    out = joins.null_tolerant_join(left, right, {k: k for k in ("member", "mrn", "practice")}, never_on_null=["practice"])
    assert sorted((r["mrn"] or "", r["v"] or 0) for r in out.collect()) == [("", 0), ("x", 2)]


def test_flag_exists_does_not_fan_out(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    other = spark.createDataFrame([("a",), ("a",)], "k string")
    assert sorted(map(tuple, joins.flag_exists(df, other, {"k": "k"}, "f").collect())) == [("a", 1), ("b", 0)]


def test_rolling_range_sum(spark):
    months = [202402 + i for i in range(11)] + [202501, 202401]
    data = spark.createDataFrame([(m, "L", 1) for m in months for _ in range(2)], "yrmo int, lob string, mm int")
    driver = spark.createDataFrame([(202402, 202501)], "window_start int, window_end int")
    out = aggregate.rolling_range_agg(data, driver, "yrmo", ["lob"], {"mm": "mm"}).collect()
    assert [(r["window_end"], r["mm"]) for r in out] == [(202501, 24)]


def test_slices_overlap(spark):
    df = spark.createDataFrame([("Commercial", 1, "m1"), ("Commercial", 0, "m2"), ("Medicare", 0, "m1")], "lob string, fi int, m string")
    slices = {"Commercial": c("lob").isin("Commercial", "Medicare"), "Commercial FI": (c("lob") == "Commercial") & (c("fi") == 1)}
    aggs = [F.countDistinct("m").alias("members"), F.count(F.lit(1)).alias("n")]
    one = sorted(map(tuple, aggregate.slice_agg(df, slices, "s", [], aggs).collect()))
    two = sorted(map(tuple, aggregate.slice_agg_union(df, slices, "s", [], aggs).collect()))
    assert one == two == [("Commercial", 2, 3), ("Commercial FI", 1, 1)]


def test_usage_cost(spark):
    df = spark.createDataFrame([("s", 1_000_000, 100_000, 1.0, 1), ("s", 0, 0, 2.0, 2), (None, 8, 0, 0.5, 3)], "step string, input_tokens long, output_tokens long, response_time_seconds double, i int")
    total = {r["step"]: r for r in aggregate.usage_rollup(df).collect()}
    assert total["s"]["cost_usd"] == 2.25 and total["s"]["calls"] == 2 and total["unknown"]["cost_usd"] == 0.00001
    assert total["all_steps"]["response_time_seconds"] == 3.5
    last = {r["step"]: r for r in aggregate.usage_rollup(df, "last", ["i"]).collect()}
    assert last["s"]["cost_usd"] == 0 and last["all_steps"]["cost_usd"] == 2.25001


def test_dx_pivot(spark):
    rows = [
        ("c1", "A", "DXICD10", "Y", "1"), ("c1", "B", "DXICD10", "N", "2"), ("c1", "Z", "DXICD9", "Y", "1"),
        ("c2", "A", "DXICD10", "Y", "10"), ("c2", "A", "DXICD10", "Y", "2"), ("c2", "P", "PXICD10", None, "1"), ("c3", "Q", "DXICD10", None, "x"),
    ]
    df = spark.createDataFrame(rows, "claim string, code string, code_desc string, poa string, prmry_ind string")
    out = {(r["claim"], r["icd_version"]): r for r in reshape.dx_wide(df, ["claim"]).collect()}
    assert set(out) == {("c1", "10"), ("c1", "09"), ("c2", "10"), ("c3", "10")}
    assert out["c1", "10"]["D1_D"] == "A" and out["c1", "10"]["D2_P"] == "N" and out["c1", "09"]["D1_D"] == "Z"
    assert out["c2", "10"]["D10_D"] == "A" and out["c2", "10"]["D2_D"] is None
    assert [r["D1_PR"] for r in reshape.px_wide(df, ["claim"]).collect()] == ["P"]


def test_primary_taxonomy(spark):
    names = [f"hc_prov_taxon_cd_{i}" for i in range(1, 16)] + [f"hc_prov_prim_taxon_switch_{i}" for i in range(1, 16)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ["npi", "prov_bus_mail_addr_postal_cd", *names]])

    def row(npi, slots):
        codes = [slots.get(i, (None, None))[0] for i in range(1, 16)]
        return (npi, "10001", *codes, *[slots.get(i, (None, None))[1] for i in range(1, 16)])

    df = spark.createDataFrame([row("n1", {2: ("B", "N"), 10: ("J", "N")}), row("n2", {1: ("A", "N"), 3: ("C", "Y")})], schema)
    xwalk = spark.createDataFrame([("J", "cl", "sp", "PCP")], "code string, classification string, specialization string, pcp_spc string")
    out = {r["npi"]: r for r in reshape.primary_taxonomy(df, xwalk).collect()}
    assert out["n1"]["taxonomy_code"] == "J" and out["n1"]["pcp_spc"] == "PCP" and out["n2"]["taxonomy_code"] == "C"


def test_latest_n(spark):
    df = spark.createDataFrame([("a", f"2024{i:02d}01", i) for i in range(1, 11)] + [("b", "20240101", 9)], "k string, d string, p int")
    out = {r["k"]: r for r in reshape.latest_n_wide(df, ["k"], [c("d").desc()], {"p": "p{}"}, 8).collect()}
    assert [out["a"][f"p{i}"] for i in range(1, 9)] == [10, 9, 8, 7, 6, 5, 4, 3]
    assert out["b"]["p1"] == 9 and out["b"]["p2"] is None


def test_upsert_policies(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    new = spark.createDataFrame([("a", ""), ("b", "9"), ("c", "3")], "k string, v string")

    def run(policy, **kw):
        return sorted(map(tuple, upsert.upsert(old, new, ["k"], {"v": policy}, **kw).collect()))

    assert run("prefer_nonempty") == [("a", "1"), ("b", "9"), ("c", "3")]
    assert run("replace") == [("a", ""), ("b", "9"), ("c", "3")]
    assert run("replace", insert_unmatched=False) == [("a", ""), ("b", "9")]
    again = upsert.upsert(upsert.upsert(old, new, ["k"], {"v": "replace"}), new, ["k"], {"v": "replace"})
    assert sorted(map(tuple, again.collect())) == run("replace")
    lists = spark.createDataFrame([("a", ["x", "x"])], "k string, v array<string>")
    more = spark.createDataFrame([("a", ["y", "x", "y"])], "k string, v array<string>")
    assert upsert.upsert(lists, more, ["k"], {"v": "append_distinct"}).first()["v"] == ["x", "x", "y"]


def test_rule_cascade_first_match(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "v int")
    value, number = project.rule_cascade([(c("v") == 0, "zero"), (c("v") < 2, "small")], " ")
    assert [tuple(r) for r in df.select("v", value, number).collect()] == [(0, "zero", "1"), (1, "small", "2"), (2, " ", " ")]
