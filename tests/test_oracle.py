"""Every query with an oracle equals its DuckDB SQL on the smallest scale."""

import math
import os

import duckdb
import pytest

from affinity.plans import catalog, oracle

from conftest import SF_SMALL

TABLES = ["customer", "part", "orders", "lineitem"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "hour") and hasattr(v, "date"):   # pandas / datetime timestamps of DATE columns
        return v.date()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows([r.asDict() for r in df.collect()], cols)
    odf = con.execute(oracle.queries()[name]).fetchdf()
    assert sorted(odf.columns) == cols
    want = _rows(odf.to_dict("records"), cols)
    assert got == want
