"""The SQL of the operators that have some, on the smallest tables."""

import duckdb
import pytest

from ledgerloom.llm import registry


@pytest.mark.parametrize("name, tables", [("op11_hard_negatives", ["embeddings"]), ("op13_importance", ["documents", "benchmark"])])
def test_query_and_sql(spark, small, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = registry.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    want = con.sql(registry.ORACLE_SQL[name])
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr) and got
