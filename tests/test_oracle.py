"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 9)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
