"""Every catalogue query against its DuckDB oracle (the driver's gate, run on
the small fixture so the suite stays fast; tools/check_oracle.py runs sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import SF_SMALL
from tidewater.plans.oracle import ORACLE
from tidewater.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events").split()


def _norm(v):
    # exact comparison, floats included (decimals compared as their double)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def _sorted(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE[name])
    assert cols == sorted(rel.columns)
    got = _sorted(tuple(r[c] for c in cols) for r in df.collect())
    want = _sorted(rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "budget_status" in df.columns
