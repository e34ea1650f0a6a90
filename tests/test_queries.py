"""Every query with SQL gives the rows of that SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, other, name):
    ours = __spark_entry__.queries()[name](spark, SF).toArrow()
    theirs = other.sql(SQL[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    rows = [sorted(tuple(map(str, map(plain, r))) for r in zip(*(t[c].to_pylist() for c in columns), strict=True)) for t in (ours, theirs)]
    assert rows[0] == rows[1]


def test_all_queries_are_known():
    known = __spark_entry__.queries()
    assert set(SQL) <= set(known)
    if "pipeline" in known:
        assert [sum(n.startswith(f"op{k}_") for n in known) for k in range(1, 14)] == [1] * 13


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
