"""Driver contract + DuckDB oracle on the small scale factor for every query
that has an oracle statement (values compared order-insensitively)."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "orders", "lineitem", "documents", "benchmark"]
SKIP_SLOW = {"eta_predictions", "eta_oof", "risk_predictions"}


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(s) >= 80
    assert SKIP_SLOW <= set(q) - set(s)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["method", "scope", "n_snapshots", "mae_hours", "rmse_hours"]


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    s = _norm(E.queries()[name](spark, "/root/testdata/sf0.001").toPandas())
    d = _norm(con.execute(E.oracle_sql()[name]).df())
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    for c in s.columns:
        for u, v in zip(s[c].tolist(), d[c].tolist()):
            if isinstance(u, float) and isinstance(v, float):
                assert (math.isnan(u) and math.isnan(v)) or u == v, (c, u, v)
            else:
                assert (pd.isna(u) and pd.isna(v)) if not isinstance(u, (list, tuple)) and pd.isna(u) else u == v, (c, u, v)
