"""Every registered query with an oracle SQL agrees with DuckDB (sf0.001)."""

import hashlib
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from trackstream.plans.oracle import SQL as PLAN_SQL
from trackstream.plans.stream_oracle import STREAM_SQL

SQL = {**PLAN_SQL, **STREAM_SQL}
QUERIES = E.queries()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return int(v) if v == int(v) and abs(v) < 2 ** 53 else v
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _digest(pdf):
    cols = sorted(pdf.columns)
    rows = sorted(repr(tuple(_norm(x) for x in rec))
                  for rec in pdf[cols].itertuples(index=False, name=None))
    return cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


def test_every_query_is_registered():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    s = QUERIES[name](spark, SF_SMALL).toPandas()
    d = duck.execute(SQL[name]).df()
    assert len(s) == len(d)
    assert _digest(s) == _digest(d)


def test_entry(spark):
    df = E.entry(spark)
    assert "trend_summary" in df.columns and df.count() == 393
