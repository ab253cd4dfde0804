"""Every registered job against its DuckDB oracle on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from carestar.registry import JOBS, SINK_JOBS

SF = os.environ.get("CARESTAR_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


CLAIMS = {*JOBS, *SINK_JOBS}
QUERIES = {k: v for k, v in E.queries().items() if k in CLAIMS}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in CLAIMS}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) >= 1
        return
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_job_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["drug_description", "fill_count", "unique_patients", "total_base_cost",
                          "total_payer_coverage", "total_revenue", "avg_cost_per_fill"]
    assert 0 < df.count() <= 25
