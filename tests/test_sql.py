"""Every query with SQL equals it on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(small):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(small):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{small}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    rel = duck.sql(entry.oracle_sql()[name])
    at = {c: i for i, c in enumerate(rel.columns)}
    cols = sorted(df.columns)
    assert sorted(at) == cols
    ours = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    theirs = sorted(repr([plain(r[at[c]]) for c in cols]) for r in rel.fetchall())
    assert ours == theirs


def test_entry_has_rows(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    assert entry.entry(spark).count() > 0


def test_all_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
