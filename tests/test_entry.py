"""Driver contract and the oracle gate on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as entry
from kontor.oracle import ORACLE
from kontor.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "as_tuple"):
        return format(v.normalize(), "f")
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "account_rk" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    o_cols = [x[0] for x in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert canon(df.columns, s_rows) == canon(o_cols, o_rows)
