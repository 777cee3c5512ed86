"""Registered queries next to their checking SQL on the smallest data set; the long jobs run in check_oracle.py."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from check_oracle import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
LONG = (
    "hcg", "unified", "patient_seen", "visit_", "legacy", "publish", "running", "drug_master", "bridge_members", "ryan", "appointments",
)
QUICK = [n for n in entry_point.oracle_sql() if not n.startswith(LONG)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_same_rows(spark, duck, name):
    df = entry_point.queries()[name](spark, FOLDER)
    result = duck.execute(entry_point.oracle_sql()[name])
    cols = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, df.collect()) == rows_of(cols, result.fetchall())


def test_every_checked_query_exists():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
