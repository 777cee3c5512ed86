"""The registered queries of this subpackage next to their checking SQL, on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from check_oracle import TABLES, rows_of
from claimspark.llm import queries  # noqa: F401
from claimspark.llm.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    cols = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, df.collect()) == rows_of(cols, result.fetchall())


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))
    assert set(QUERIES) <= set(entry_point.queries()) and "pipeline" in entry_point.queries()
