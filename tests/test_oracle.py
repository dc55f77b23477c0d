"""``queries()`` against ``oracle_sql()`` through DuckDB on the sf0.001 tables (the
driver runs the same check on sf0.01)."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = ["events_wide", "purchases", "sessions_full", "items_union", "new_users", "intraday_tail",
        "sessions_intraday", "global_sequence", "channel_session", "incremental_daily", "sessions_hot_split"]


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "<null>"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        f = float(v)
        return "<null>" if f != f else repr(round(f, 6))
    return str(v)


def _norm(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_declared():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 63


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    s = E.queries()[key](spark, SF).toPandas()
    o = con.sql(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _norm(s) == _norm(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "acquisition_channel_group" in df.columns
