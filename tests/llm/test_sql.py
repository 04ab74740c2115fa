"""Queries with SQL equal it in DuckDB on the smallest scale."""

from collections import Counter

import duckdb
import pytest

from affinity.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(queries.oracle_sql()[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(names) == cols
    # as bags: columns may hold nulls
    assert Counter(tuple(r[names.index(c)] for c in cols) for r in want) == Counter(tuple(r[c] for c in cols) for r in df.collect())
