"""Checked publish: a load that fails or breaks a rule leaves the table as it was; the change feed names exactly what changed."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from conftest import as_set, members

from pulsegrid.operators import bitmaps, cubes
from pulsegrid.operators import publish as P
from pulsegrid.operators.activity import attach_country
from pulsegrid.plans.cube_build import follow_loads
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS

D1, D2, D3 = date(2025, 7, 1), date(2025, 7, 2), date(2025, 7, 30)
NULLABLE = "activity_date date, user_id string, country string, platform string"


def rows(spark, *tuples):
    return spark.createDataFrame(list(tuples), NULLABLE)


@pytest.fixture
def table(spark, tmp_path):
    name = f"fact_{uuid.uuid4().hex[:8]}"
    P.create_published_fact(spark, name, str(tmp_path / "fact"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def state(spark, table):
    return as_set(spark.table(table).select(*FACT_COLUMNS)), P.partition_locations(spark, table, [D1, D2, D3])


FIRST = [(D1, "ann", "NO", "tv"), (D1, "bob", "SE", "tv"), (D2, "ann", "NO", "tv")]


def test_loads_and_their_changes(spark, table):
    one = P.publish_load(spark, rows(spark, *FIRST), table)
    assert one.dates == [D1, D2] and one.superseded == [] and state(spark, table)[0] == set(FIRST)
    old = state(spark, table)[1]
    # The same again, and one of its days: nothing to change, nothing written.
    for again in (FIRST, FIRST[:1]):
        assert P.publish_load(spark, rows(spark, *again), table).dates == []
    assert P.publish_load(spark, rows(spark), table).dates == []
    # A user who moved, and a day far away; the other day keeps its folder.
    two = P.publish_load(spark, rows(spark, (D1, "ann", "DK", "tv"), (D2, "ann", "NO", "tv"), (D3, "cat", "NO", "pc")), table)
    now, where = state(spark, table)
    assert two.dates == [D1, D3] and now == {(D1, "ann", "DK", "tv"), (D1, "bob", "SE", "tv"), (D2, "ann", "NO", "tv"), (D3, "cat", "NO", "pc")}
    assert where[D2] == old[D2] and where[D1] != old[D1] and two.superseded == [old[D1]]
    # Insert-only: a stored key stays as it is.
    P.publish_load(spark, rows(spark, (D1, "ann", "FI", "tv"), (D1, "eve", "FI", "tv")), table, mode="insert_only")
    assert state(spark, table)[0] == now | {(D1, "eve", "FI", "tv")}
    assert P.publish_load(spark, rows(spark, (D1, "ann", "FI", "tv")), table, mode="insert_only").dates == []
    feed = [tuple(r)[1:] for r in sorted(P.changes(spark, table).collect())]
    assert feed == [(D1, 0, 2), (D2, 0, 1), (D1, 2, 2), (D3, 0, 1), (D1, 2, 3)]
    assert {r.activity_date for r in P.changes(spark, table, after=one.load).collect()} == {D1, D3}
    P.drop_superseded(spark, two)
    assert as_set(spark.table(table).where("activity_date = '2025-07-01'"), "user_id") == {("ann",), ("bob",), ("eve",)}


@pytest.mark.parametrize("bad", [
    [(D1, "dan", "NO", "tv"), (D1, "dan", "SE", "tv")], [(D3, "dan", None, "tv")], [(D3, None, "NO", "tv")], [(None, "dan", "NO", "tv"), (D3, "dan", "NO", "tv")]])
def test_a_batch_that_breaks_a_rule(spark, table, tmp_path, bad):
    P.publish_load(spark, rows(spark, *FIRST), table)
    before = state(spark, table)
    with pytest.raises(ValueError, match="fact table"):
        P.publish_load(spark, rows(spark, *bad), table)
    assert state(spark, table) == before and P.changes(spark, table).count() == 2
    assert len(list((tmp_path / "fact/loads").iterdir())) == 1  # nothing is left of it


def test_a_load_that_fails_while_it_is_written(spark, table):
    P.publish_load(spark, rows(spark, *FIRST), table)
    before = state(spark, table)

    def lost(_):
        raise OSError("lost")

    with pytest.raises(OSError):
        P.publish_load(spark, rows(spark, (D1, "dan", "NO", "tv")), table, audit=lost)
    assert state(spark, table) == before


def test_a_second_writer_is_noticed(spark, table):
    P.publish_load(spark, rows(spark, *FIRST), table)

    def other(_):
        P.publish_load(spark, rows(spark, (D1, "eve", "FI", "tv")), table)

    with pytest.raises(P.LoadConflict):
        P.publish_load(spark, rows(spark, (D1, "dan", "NO", "tv")), table, audit=other)
    assert state(spark, table)[0] == {*FIRST, (D1, "eve", "FI", "tv")}


def test_a_driver_lost_while_publishing(spark, table, monkeypatch):
    """Some partitions point at the new folder, the rest not: every day is whole, and the load can be finished."""
    P.publish_load(spark, rows(spark, *FIRST), table)
    seen = {}
    monkeypatch.setattr(P, "finish_publish", lambda *a: seen.update(args=a))
    P.publish_load(spark, rows(spark, (D1, "dan", "NO", "tv"), (D2, "dan", "NO", "tv")), table)
    assert state(spark, table)[0] == set(FIRST)
    monkeypatch.undo()
    load, days = seen["args"][2:]
    spark.sql(f"ALTER TABLE {table} PARTITION (activity_date='2025-07-01') SET LOCATION '{P.table_location(spark, table)}/loads/{load}/activity_date=2025-07-01'")
    P.finish_publish(spark, table, load, days)
    P.finish_publish(spark, table, load, days)
    assert state(spark, table)[0] == {*FIRST, (D1, "dan", "NO", "tv"), (D2, "dan", "NO", "tv")} and P.changes(spark, table).count() == 4


def test_dates_are_pruned(spark, table):
    P.publish_load(spark, rows(spark, *FIRST), table)
    plan = spark.table(table).where("activity_date = '2025-07-02'")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [(activity_date" in plan
    assert plan.count("activity_date=2025-07-02") == 1 and "activity_date=2025-07-01" not in plan  # the one folder that is read


def test_cube_and_bitmaps_follow_the_feed(spark, table, tmp_path):
    base = str(tmp_path / "dash")
    P.publish_load(spark, rows(spark, *FIRST), table)
    assert follow_loads(spark, table, base).dates == [D1, D2]
    files = lambda day: {p.name for part in ("cube", "bitmaps") for p in (tmp_path / "dash" / part / f"activity_date={day}").glob("*.parquet")}
    untouched = files(D2)
    P.publish_load(spark, rows(spark, (D1, "ann", "DK", "tv"), (D3, "cat", "UNKNOWN", "pc"), (D2, "ann", "NO", "tv")), table)
    P.publish_load(spark, rows(spark, (D3, "ann", "NO", "pc")), table)
    out = follow_loads(spark, table, base)
    assert out.dates == [D1, D3] and files(D2) == untouched and untouched
    fact = spark.table(table).select(*FACT_COLUMNS)
    assert as_set(out.cube) == as_set(cubes.build_cube(fact).select(*out.cube.columns))
    meta = spark.read.json(f"{out.export_path}/meta").first()
    assert (meta.n_days, meta.total_users, meta.unknown_users) == (3, 3, 1)
    assert follow_loads(spark, table, base).dates == []
    assert as_set(bitmaps.users_by(out.bitmaps, "country")) == {("NO", 1), ("SE", 1), ("DK", 1), ("UNKNOWN", 1)}
    assert as_set(bitmaps.distinct_users(out.bitmaps, D1, D2)) == {(2,)}
    assert as_set(bitmaps.distinct_users(out.bitmaps, D2, D2, "SE")) == {(0,)}


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_clustered_tables_are_joined_and_merged_where_they_lie(spark, tmp_path):
    fact, accounts = f"fact_{uuid.uuid4().hex[:8]}", f"accounts_{uuid.uuid4().hex[:8]}"
    P.create_published_fact(spark, fact, str(tmp_path / "fact"), buckets=4)
    try:
        P.publish_accounts(spark, members(spark, ("ann", "NO"), ("bob", "SE")), accounts, str(tmp_path), 4)
        P.publish_accounts(spark, members(spark, ("ann", "DK"), ("cat", "FI"), ("cat", "IS", "2026-01-01T00:00:00")), accounts, str(tmp_path), 4)
        assert as_set(spark.table(accounts)) == {("ann", "DK"), ("cat", "IS")}
        P.publish_load(spark, rows(spark, *FIRST), fact)
        P.publish_load(spark, rows(spark, (D1, "ann", "DK", "tv"), (D1, "eve", "NO", "pc")), fact)
        assert as_set(spark.table(fact).select(*FACT_COLUMNS)) == {(D1, "ann", "DK", "tv"), (D1, "bob", "SE", "tv"), (D1, "eve", "NO", "pc"), (D2, "ann", "NO", "tv")}
        files = list((tmp_path / "fact").rglob("activity_date=2025-07-01/*.parquet"))
        assert files and all("_0000" in f.name for f in files)  # the bucket is in the name
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        grain = rows(spark, (D1, "ann", None, "tv")).select("activity_date", "user_id", "platform")
        joined = _plan(attach_country(grain, spark.table(accounts)))
        assert joined.count("Exchange hashpartitioning(user_id") == 1  # the new rows; the accounts are read as they lie
        with P._clustering_counts(spark):
            old = spark.table(fact).select(*FACT_COLUMNS)
            merged = _plan(old.join(rows(spark, (D1, "ann", "DK", "tv")), FACT_KEYS, "left_anti").select(*FACT_COLUMNS))
            assert merged.count("Exchange hashpartitioning(user_id") == 1 and "Exchange hashpartitioning(activity_date" not in merged
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in (fact, accounts):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
