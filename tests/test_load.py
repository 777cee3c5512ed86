import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimspark.jobs import hcg, pipeline
from claimspark.plans.domain import Domain
from claimspark.plans.q_visits import _tables
from claimspark.session import bucketed, scratch, stored
from claimspark.sinks.load import JobLog, append, overwrite, overwrite_partitions
from claimspark.sinks.versions import VersionedTable
from claimspark.sources.mappings import read_mappings
from claimspark.sources.scripts import read_scripts
from claimspark.sources.tables import read_table, split_read


def test_partition_replace_keeps_other_lobs(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("p", "MA", 1), ("p", "Medicare", 2), ("q", "MA", 3)], "payer string, srclob string, v int")
    assert overwrite_partitions(first, path, ["payer", "srclob"]) == 3
    assert overwrite_partitions(spark.createDataFrame([("p", "MA", 9)], first.schema), path, ["payer", "srclob"]) == 1
    got = sorted((r["payer"], r["srclob"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("p", "MA", 9), ("p", "Medicare", 2), ("q", "MA", 3)]


def test_overwrite_and_append_count_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert overwrite(spark.range(10), path) == 10
    assert append(spark.range(5), path) == 5
    assert read_table(spark, str(tmp_path), "t").count() == 15
    assert overwrite(spark.range(1), path) == 1


def test_clustered_files_let_a_filter_pass_over_row_groups(spark, tmp_path):
    rows = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows = rows.withColumn("key", F.when(F.col("key") > 10, F.col("key")))

    def groups(path):
        """Row groups in all, and those that may hold key 777."""
        found = []
        for f in os.listdir(path):
            if f.endswith(".parquet"):
                meta = pq.ParquetFile(f"{path}/{f}").metadata
                found += [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        return len(found), sum(x.has_min_max and x.min <= 777 <= x.max for x in found)

    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    small = {"parquet.block.size": "65536", "parquet.page.row.count.limit": "500", "parquet.block.size.row.check.min": "100"}
    assert overwrite(rows.repartition(6), plain, **small) == overwrite(rows, laid, ["key"], **small) == 60_000
    (n, hit), (m, laid_hit) = groups(plain), groups(laid)
    assert hit == n >= 6 and m >= 4 and laid_hit <= 2
    assert spark.read.parquet(laid).where("key = 777").count() == rows.where("key = 777").count()
    assert sorted(map(str, spark.read.parquet(laid).collect())) == sorted(map(str, rows.collect()))
    table = VersionedTable(spark, str(tmp_path / "v"))
    assert table.replace(rows, ["key"]) == 60_000


def test_mapping_files_are_ordered_without_a_nested_loop(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"m{i}.csv").write_text("source_schema\ns\n")
    plan = read_mappings(spark, str(tmp_path / "*.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_run_log_isolates_failures(spark, tmp_path):
    ticks = iter(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i) for i in range(100))
    log = JobLog(spark, str(tmp_path), "CAT", clock=lambda: next(ticks))

    def fail() -> int:
        raise ValueError("boom")

    assert log.run("good", lambda: 7) and not log.run("bad", fail) and log.run("after", lambda: 0)
    state = {r["table_name"]: (r["status"], r["record_count"]) for r in log.state().collect()}
    assert state == {"good": ("Completed", 7), "bad": ("Failed", None), "after": ("Completed", 0)}
    errors = spark.read.parquet(log.errors_path).collect()
    assert [(e["table_name"], e["error_code"], "boom" in e["error_msg"]) for e in errors] == [("bad", "ValueError", True)]
    assert errors[0]["error_msg"].startswith("Traceback") and "in fail" in errors[0]["error_msg"]
    assert not log.run("bad", fail, raise_at_end=True) and log.run("later", lambda: 1)
    with pytest.raises(ExceptionGroup):
        log.finish()
    log.finish()


def _claims(spark):
    dom = Domain(spark, "/root/testdata/sf0.001")
    return dom, {n: dom.table(n) for n in (*hcg.FAMILY_TABLES, "nppes", "taxonomy_xwalk", "specialty_xwalk")}


def test_claims_load_logs_each_pair_and_empties_one_without_rows(spark, tmp_path):
    dom, family = _claims(spark)
    root, log = str(tmp_path / "out"), JobLog(spark, str(tmp_path / "log"), "HCG")
    assert pipeline.load_claims(log, root, dom.control, family, family, dt.date(2024, 1, 20))
    target = pipeline.read_loaded(spark, root, "hcg_input_claims")
    counts = {(r["payer"], r["srclob"]): r["count"] for r in target.groupBy("payer", "srclob").count().collect()}
    logged = {(r["payer"], r["category"]): r["record_count"] for r in log.state().collect()}
    assert counts and counts == {k: v for k, v in logged.items() if v}
    (payer, lob), *_ = counts
    gone = family["fact_service"].where(~((F.col("payer") == payer) & (F.col("lob") == lob)))
    assert pipeline.load_claims(log, root, dom.control, {**family, "fact_service": gone}, {**family, "fact_service": gone}, dt.date(2024, 1, 21))
    left = {(r["payer"], r["srclob"]) for r in pipeline.read_loaded(spark, root, "hcg_input_claims").select("payer", "srclob").distinct().collect()}
    assert left == set(counts) - {(payer, lob)}


def test_claims_load_isolates_a_failing_pair(spark, tmp_path):
    dom, family = _claims(spark)
    root, log = str(tmp_path / "out"), JobLog(spark, str(tmp_path / "log"), "HCG")
    pairs = [(r["payer"], r["lob"]) for r in hcg.control_branches(dom.control).orderBy("payer", "lob").collect()][:3]
    control = dom.control.where(F.concat_ws("|", "payer", "lob").isin(*("|".join(p) for p in pairs)))
    bad = pairs[1]
    here = (F.col("payer") == bad[0]) & (F.col("lob") == bad[1])
    broken = family["fact_service"].withColumn("service_code", F.when(here, F.raise_error(F.lit("bad row")).cast("string")).otherwise(F.col("service_code")))
    assert not pipeline.load_claims(log, root, control, {**family, "fact_service": broken}, {**family, "fact_service": broken}, dt.date(2024, 1, 20))
    state = {(r["payer"], r["category"]): r["status"] for r in log.state().collect()}
    assert state == {p: "Failed" if p == bad else "Completed" for p in pairs}
    errors = {(e["payer"], e["category"]): e["error_msg"] for e in spark.read.parquet(log.errors_path).collect()}
    assert set(errors) == {("ALL", "HCG"), bad} and all("bad row" in e for e in errors.values())
    loaded = pipeline.read_loaded(spark, root, "hcg_input_claims").select("payer", "srclob").distinct().collect()
    assert {tuple(r) for r in loaded} == set(pairs) - {bad}


class Stopped(Exception):
    pass


def test_load_that_stops_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    dom, family = _claims(spark)
    root, log = str(tmp_path / "out"), JobLog(spark, str(tmp_path / "log"), "HCG")
    control = dom.control.where("lob = 'Medicaid' and payer in ('REACH', 'HNACO')")
    assert pipeline.load_claims(log, root, control, family, family, dt.date(2024, 1, 20))
    before = sorted(map(str, pipeline.read_loaded(spark, root, "hcg_input_claims").collect()))
    switch = VersionedTable._switch

    def stop(self, *a):
        raise Stopped("between write and switch")

    monkeypatch.setattr(VersionedTable, "_switch", stop)
    fewer = {**family, "fact_service": family["fact_service"].where("payer = 'REACH'")}
    assert not pipeline.load_claims(log, root, control, fewer, fewer, dt.date(2024, 1, 21))
    assert sorted(map(str, pipeline.read_loaded(spark, root, "hcg_input_claims").collect())) == before
    monkeypatch.setattr(VersionedTable, "_switch", switch)
    assert pipeline.load_claims(log, root, control, fewer, fewer, dt.date(2024, 1, 22))
    after = pipeline.read_loaded(spark, root, "hcg_input_claims")
    assert {r["payer"] for r in after.select("payer").distinct().collect()} == {"REACH"}
    # what the stopped load had written is gone too
    held = {r["_load"] for r in spark.read.option("basePath", f"{root}/hcg_input_claims/data").parquet(f"{root}/hcg_input_claims/data").select("_load").distinct().collect()}
    assert len(held) == 1


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.version() == 0 and table.vacuum() == 0
    schema = "payer string, v int, lob string"
    first = spark.createDataFrame([("1199", 1, "MA"), ("p", 2, "MA"), ("p", 3, None), ("q/é", 4, "x=y")], schema)
    assert table.replace_partitions(first, ["payer", "lob"]) == {("1199", "MA"): 1, ("p", "MA"): 1, ("p", None): 1, ("q/é", "x=y"): 1}
    old = table.read()
    assert old.columns == ["v", "payer", "lob"]
    assert table.replace_partitions(spark.createDataFrame([("p", 9, "MA"), ("p", 8, "MA")], schema), ["payer", "lob"], emptied=[("1199", "MA"), ("p", "MA"), ("no", "x")]) == {("p", "MA"): 2}
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(table.read()) == sorted([(9, "p", "MA"), (8, "p", "MA"), (3, "p", None), (4, "q/é", "x=y")], key=str)
    assert len(rows(old)) == 4 and table.version() == 2 and table.counts()[("p", "MA")] == 2
    assert table.vacuum() == 0  # the first load still holds two partitions
    assert table.replace_partitions(first.where("false"), ["payer", "lob"], emptied=list(table.counts())) == {}
    assert table.read().collect() == [] and table.vacuum() == 3
    with pytest.raises(ValueError):
        table.replace_partitions(first.withColumn("more", F.lit(1)), ["payer", "lob"])
    whole = VersionedTable(spark, str(tmp_path / "w"))
    assert whole.replace(spark.range(7)) == 7 and whole.replace(spark.range(2)) == 2
    assert whole.read().count() == 2 and whole.vacuum() == 1 and whole.read().count() == 2


def test_empty_codes_of_the_warehouse_are_null(spark, tmp_path):
    dom, family = _claims(spark)
    sources = str(tmp_path / "in")
    texts = {"fact_service": ["revenue_code", "cpt_modifier1"], "claim_header": ["drg", "servicing_npi"]}
    for name, table in family.items():
        for c in texts.get(name, []):
            table = table.withColumn(c, F.coalesce(c, F.lit("")))
        for prefix in ("x_", "y_") if name in hcg.FAMILY_TABLES else ("",):
            table.write.parquet(f"{sources}/{prefix}{name}.parquet")
    dom.control.write.parquet(f"{sources}/control.parquet")
    assert pipeline.claims_job(spark, sources, str(tmp_path / "out"), str(tmp_path / "log"), dt.date(2024, 1, 20))
    got = pipeline.read_loaded(spark, str(tmp_path / "out"), "hcg_input_claims")
    assert got.where("revcode = '0000' or modifier = '' or drg = '0000' or providerid = ''").count() == 0
    plain = hcg.load_hcg(dom.control, family, family, dt.date(2024, 1, 20))
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in ("revcode", "modifier", "drg", "providerid")]
    assert got.agg(*nulls).first() == plain.agg(*nulls).first() and min(got.agg(*nulls).first()) > 0


def test_split_read():
    assert split_read("id", 1, 10, 500) == {} and split_read("id", 5, 5, 10**9) == {}
    assert split_read("id", 1, 10**8, 5_000_001) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100000001", "numPartitions": "6"}


def test_intermediates_are_deleted(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    with scratch(spark):
        kept = bucketed(spark.range(100).withColumn("k", F.col("id") % 7), ["k"], "b").groupBy("k").count().count()
        path = stored(spark.range(3), "s").inputFiles()[0]
        assert kept == 7 and path
        inside = {f for d in (shared, f"{shared}/claimspark_scratch") for f in os.listdir(d)}
    assert not {f for d in (shared, f"{shared}/claimspark_scratch") for f in os.listdir(d) if f.startswith(("b_", "s-"))} and {f[:2] for f in inside} >= {"b_", "s-"}


def test_member_pipeline_end_to_end(spark, tmp_path):
    root = str(tmp_path / "out")
    log = JobLog(spark, str(tmp_path / "log"), "UNIFIED MEMBERSHIP")
    done = pipeline.load_members(log, spark, root, _tables(Domain(spark, "/root/testdata/sf0.001")), dt.date(2024, 1, 20))
    assert all(done.values()) and len(done) == 8
    counts = {r["table_name"]: r["record_count"] for r in log.state().collect()}
    assert counts["unified_member_visits"] == counts["x_unified_member_visits"] == pipeline.read_loaded(spark, root, "x_unified_member_visits").count()
    assert counts["patient_seen_visits_data_mart"] > 0 and counts["unified_member"] > 0


def test_read_mappings(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"source_schema":"s","source_table":"t","source_column":"a","target_schema":"x","target_table":"y","target_column":"0012"}]')
    (tmp_path / "m.csv").write_text("source_schema,source_table,source_column,target_schema,target_table\n s ,t, a ,x,y\n")
    assert read_mappings(spark, str(tmp_path / "m.json")).first()["target_column"] == "0012"
    row = read_mappings(spark, str(tmp_path / "m.csv")).first()
    assert (row["source_schema"], row["source_column"], row["target_column"]) == ("s", "a", "")
    (tmp_path / "q.csv").write_text('source_schema,source_table,source_column\ns,"a ""quoted""\nname",x\ns,b,y\n')
    quoted = read_mappings(spark, str(tmp_path / "q.csv")).orderBy("pos").collect()
    assert [r["source_table"] for r in quoted] == ['a "quoted"\nname', "b"]
    (tmp_path / "many").mkdir()
    for i in range(12):
        (tmp_path / "many" / f"f{i:02d}.csv").write_text("source_schema,source_table,source_column\n" + "".join(f"s,t{i:02d},c{j}\n" for j in range(5)))
    rows = read_mappings(spark, str(tmp_path / "many" / "*.csv")).orderBy("pos").collect()
    assert [(r["source_table"], r["source_column"]) for r in rows] == [(f"t{i:02d}", f"c{j}") for i in range(12) for j in range(5)]
    assert read_mappings(spark, str(tmp_path / "none.json")).isEmpty() and read_mappings(spark, None).isEmpty()
    with pytest.raises(ValueError):
        read_mappings(spark, str(tmp_path / "m.xml"))


def test_read_scripts(spark, tmp_path):
    (tmp_path / "a.sql").write_bytes("select 'é'".encode())
    (tmp_path / "b.sql").write_bytes("select 'é'".encode("latin-1"))
    (tmp_path / "c.txt").write_text("x")
    got = {r["script"]: r["text"] for r in read_scripts(spark, str(tmp_path)).collect()}
    assert got == {"a.sql": "select 'é'", "b.sql": "select 'é'"}
    (tmp_path / "d.sql").write_text("  \n")
    assert read_scripts(spark, str(tmp_path), strict=False).count() == 2
    with pytest.raises(Exception, match="script is empty"):
        read_scripts(spark, str(tmp_path)).agg(F.max("text")).collect()
