"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from glossa.plans.queries import ORACLES, QUERIES
from glossa.sources.tables import TABLES
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in recs),
                                            key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["filepath", "n_pending", "n_groups", "n_deduped", "n_units"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())
