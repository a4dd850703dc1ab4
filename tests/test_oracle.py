"""Every registered batch query against its SQL statement in DuckDB, at sf0.001."""

import datetime as dt
import json
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from conftest import SF_TINY
from __spark_entry__ import entry
from pulsegrid.plans.catalog import QUERIES
from pulsegrid.plans.oracle import ORACLE

NAMES = [n for n in QUERIES if not n.startswith("stream_") or n in ("stream_fact_late", "stream_fact_published", "stream_dau_preview", "stream_ccu_corrections")]


def _norm(v):
    if isinstance(v, float):  # exact: means are exact decimal sums, averages integer ratios
        return "NaN" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: json.dumps(t, default=str))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(SF_TINY).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["activity_date", "dau"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_TINY)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, df.collect()) == _canon(ocols, res.fetchall())
