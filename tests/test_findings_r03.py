"""Findings of round 3 on small tables of their own rows."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as E

TABLES = {
    "region": "VALUES (0, 'EAST') t(r_regionkey, r_name)",
    "nation": "VALUES (0, 'X', 0), (1, 'Y', 0) t(n_nationkey, n_name, n_regionkey)",
    "customer": "(SELECT i AS c_custkey, 'C' || i AS c_name, cast(i % 2 AS integer) AS c_nationkey, "
                "cast(i * 10 AS double) AS c_acctbal, 'BUILDING' AS c_mktsegment FROM range(1, 5) r(i))",
    "supplier": "(SELECT i AS s_suppkey, 'S' || i AS s_name, 0 AS s_nationkey, "
                "cast(i AS double) AS s_acctbal FROM range(1, 3) r(i))",
    "part": "(SELECT i AS p_partkey, 'part ' || i AS p_name, 'Brand#1' AS p_brand, 'T' AS p_type, "
            "cast(i AS integer) AS p_size, cast(9.5 AS double) AS p_retailprice FROM range(1, 4) r(i))",
    # encounters of 1994 and 1997, fills of 1995 and 1998
    "orders": "(SELECT i AS o_orderkey, 1 + i % 4 AS o_custkey, 'F' AS o_orderstatus, "
              "cast(100 AS double) AS o_totalprice, if(i = 1, TIMESTAMP '1994-03-04 05:00:00', "
              "TIMESTAMP '1997-01-01') AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(1, 6) r(i))",
    "lineitem": "(SELECT i AS l_orderkey, 1 + i % 3 AS l_partkey, 1 + i % 2 AS l_suppkey, "
                "1::integer AS l_linenumber, 2.0::double AS l_quantity, 50.0::double AS l_extendedprice, "
                "0.1::double AS l_discount, 0.0::double AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus, "
                "if(i = 1, TIMESTAMP '1995-06-07', TIMESTAMP '1998-02-03') AS l_shipdate FROM range(1, 6) r(i))",
    "events": "(SELECT i AS event_id, TIMESTAMP '1997-01-01' AS ts, i AS user_id, 'a' AS event_type, "
              "1.5::double AS value, 'p' AS props FROM range(1, 3) r(i))",
}


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("r03"))
    con = duckdb.connect()
    for name, rows in TABLES.items():
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"COPY (SELECT * FROM {rows if rows[0] == '(' else '(' + rows.replace(') t(', ')) t(', 1)}) "
                    f"TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return folder, con


def _both(spark, tables, name):
    folder, con = tables
    df = E.queries()[name](spark, folder)
    cur = con.execute(E.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    return ([r.asDict() for r in df.collect()], [dict(zip(names, r)) for r in cur.fetchall()])


def test_dim_date_covers_every_year_of_the_facts(spark, tables):
    for rows in _both(spark, tables, "dim_date"):
        days = sorted(r["full_date"] for r in rows)
        assert (days[0], days[-1], len(days)) == (dt.date(1994, 1, 1), dt.date(1998, 12, 31), 1826)


def test_star_row_counts_counts_every_day(spark, tables):
    for rows in _both(spark, tables, "star_row_counts"):
        assert {r["tbl"]: r["rows"] for r in rows}["dim_date"] == 1826


def test_slicer_domains_lists_every_year(spark, tables):
    for rows in _both(spark, tables, "slicer_domains"):
        assert [r["value"] for r in sorted(rows, key=lambda r: r["position"])
                if r["dimension"] == "years"] == ["1994", "1997"]


@pytest.mark.parametrize("name", ["bi_encounter", "catalog_views", "search_domains", "filters_document"])
def test_other_reports_keep_their_calendar(spark, tables, name):
    """Their SQL is as it was: dates before 1996 have no attributes there."""
    got, wanted = _both(spark, tables, name)
    assert sorted(map(repr, (sorted(r.items()) for r in got))) == \
        sorted(map(repr, (sorted(r.items()) for r in wanted)))


def test_types_are_inferred_in_one_aggregate_per_column(spark, monkeypatch):
    """a value is tested once for all types, not once per type."""
    from carestar.sources import csvscan

    rows = [("7", "1e3", "2020-01-02", "true", "2020-01-02 03:04:05", "1234-5", " "),
            ("-8", "5", "2020-1-3", "FALSE", "2020-01-03", "x", None)]
    df = spark.createDataFrame(rows, "i string, f string, d string, b string, t string, s string, n string")
    seen = []
    monkeypatch.setattr(type(df), "agg", lambda self, *a, f=type(df).agg: (seen.append(len(a)), f(self, *a))[1])
    assert csvscan.infer_types(df) == {"i": "bigint", "f": "double", "d": "date", "b": "boolean",
                                       "t": "timestamp", "s": "string", "n": "string"}
    assert seen == [len(df.columns)]


def test_marks_of_faulty_rows_are_compiled(spark):
    """no array is filtered by a lambda for every row."""
    from carestar.sources.ingest import CORRUPT, typed_by_name
    from carestar.sources.schemas import CONDITIONS

    text = spark.createDataFrame([("2020-01-01", "", "p"), ("no", "never", "q")],
                                 "START string, STOP string, PATIENT string")
    df = typed_by_name(text, CONDITIONS)
    assert "lambda" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r[CORRUPT] for r in df.orderBy("PATIENT").collect()] == [None, "START,STOP"]
