"""Every SQL-twinned query equals its DuckDB oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL

ORACLE = se.oracle_sql()
# many fits each; the driver's SQL check and tools/check_oracle.py run them
SLOW = {"tune_lr", "tune_rf", "tune_gbt", "train_gbt"}
QUERIES = se.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 13
    assert set(df.columns) == {"feature", "mean_0", "mean_1", "diff"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    con = duck(SF_SMALL)
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(ORACLE[name])
    ocols = rel.columns
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == want
