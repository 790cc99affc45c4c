"""Every query that has SQL gives the same rows as DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom import queries as catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries that find nothing on the smallest tables.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, small, duck, name):
    df = catalogue.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert got or name in EMPTY


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
