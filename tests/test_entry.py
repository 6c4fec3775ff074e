"""The driver contract: entry(), and every registered query (batch and
streaming) against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewater.plans.queries import QUERIES
from tidewater.sources.tables import TABLES, table_path
from tidewater.streaming.queries import STREAM_QUERIES

SF = "/root/testdata/sf0.001"
OWN = {**QUERIES, **STREAM_QUERIES}  # optional subpackages test their own queries
ALL = sorted(OWN)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "cnt"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.queries())
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    d = duck.sql(entry.oracle_sql()[name])
    assert sorted(d.columns) == cols
    idx = [d.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in d.fetchall()), key=repr)
    assert got == want
