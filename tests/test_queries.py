"""Every registered query against its DuckDB oracle on the smallest driver tables
(the same check the driver runs at sf0.01), plus the contract of ``__spark_entry__``."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E

from __spark_entry__ import SMOKE_DIR

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SLOW = {"scd1_stream", "analytics_stream", "energy_stream"}  # covered by test_streaming


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def test_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 30


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["business_date", "country_code", "location_id", "unit_id"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SMOKE_DIR)
    cols = sdf.columns
    srows = sdf.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = [ocols.index(cols[i]) for i in order]
    got = sorted(tuple(_norm(r[i]) for i in order) for r in srows)
    want = sorted(tuple(_norm(r[i]) for i in oorder) for r in orows)
    assert len(got) == len(want)
    assert got == want
