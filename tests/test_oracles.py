"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import os

import pytest

from places import ROOT, SMALL

import sys
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import duck, rows_multiset, type_mismatches  # noqa: E402

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert not type_mismatches(df, res)
    assert rows_multiset(df.columns, rows) == rows_multiset(res.columns, res.fetchall())


def test_every_query_is_registered_with_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["model_version", "n_scored"]
    assert df.count() == 3
