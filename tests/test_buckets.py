"""Claims on their way to buckets: what they leave on disk, and what moves."""

import os
import time

from claimspark import session
from claimspark.jobs import hcg
from claimspark.session import bucketed, free_shuffles, shared_folder


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_rows_go_to_their_buckets_part_by_part_and_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(session, "PART_BYTES", 1)
    free_shuffles(spark)
    before = shuffle_files(spark)
    rows = spark.range(0, 1000, 1, 6).selectExpr("case when id % 7 > 0 then id % 7 end as k", "id", "cast(null as string) as s")
    table = bucketed(rows.unionByName(rows), ["k"], "parts", 3)
    assert table.schema.names == ["k", "id", "s"] and table.exceptAll(rows.unionByName(rows)).isEmpty() and table.count() == 2000
    assert len(table.inputFiles()) > 3
    assert "Exchange" not in table.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in os.listdir(shared_folder(spark).removeprefix("file://")) if f.startswith("parts-rows")]
    table = bucketed(rows.repartition(4, "id"), ["k"], "parts", 3)
    for _ in range(30):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_no_rows_are_an_empty_table(spark):
    table = bucketed(spark.range(0).selectExpr("id", "'x' as k"), ["k"], "none", 2)
    assert table.columns == ["id", "k"] and table.isEmpty()


def test_headers_stay_where_they_are_and_meet_claims_by_provider(spark):
    key = "claim_id string, member_id string, lob string, payer string"
    claims = spark.createDataFrame(
        [("1", "M", "L", "P", "a", 1), ("1", "M", "L", "P", None, 1), ("1", "M", "L", "P", "a", 2), ("2", "M", "L", "P", None, 3), (None, "M", "L", "P", None, 4)], f"{key}, servicing_npi string, n int"
    )
    headers = spark.createDataFrame(
        [("1", "M", "L", "P", "x", "a"), ("1", "M", "L", "P", "y", "a"), ("1", "M", "L", "P", "z", None), ("9", "M", "L", "P", "o", "a"), (None, "M", "L", "P", "n", None)], f"{key}, drg string, servicing_npi string"
    )
    got = hcg._with_headers(claims, headers)
    assert got.columns == [*claims.columns, "drg"]
    seen = sorted((r["n"], r["servicing_npi"] or "", r["drg"] or "") for r in got.collect())
    assert seen == [(1, "", "z"), (1, "a", "x"), (1, "a", "y"), (2, "a", "x"), (2, "a", "y"), (3, "", ""), (4, "", "")]
    by_claim = [bucketed(t, hcg.CLAIM_SORT, "met", 2) for t in (claims, headers)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in hcg._with_headers(*by_claim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
