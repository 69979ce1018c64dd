"""Every registered query against its DuckDB oracle (row count + values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

SF_ORACLE = os.environ.get("CATALOOM_ORACLE_SF", "/root/testdata/sf0.001")
KEYS = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF_ORACLE)
    if r["exact"] is None:  # corpus queries without SQL, tested against brute force
        assert name.startswith("op") or name == "pipeline"
        assert r["rows"] > 0
        return
    assert r["cols"], r.get("detail")
    assert r["rows"] == r["oracle_rows"]
    assert r["exact"], r.get("detail")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["customer__c_mktsegment", "revenue", "n_lines"]


def test_every_sql_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
