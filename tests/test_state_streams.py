"""Streams with bounded state: late rows are counted and merged, closed hours are final, a restart goes on from the checkpoint."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import SF_TINY, as_set, json_lines, members

from pulsegrid.operators.publish import create_published_fact, partition_locations
from pulsegrid.plans import catalog
from pulsegrid.streaming import routing
from pulsegrid.streaming.ccu_hours import closed_until, hour_states, rejected_minutes, run_ccu_hours_stream
from pulsegrid.streaming.dau_preview import preview_of_range, run_dau_preview_stream
from pulsegrid.streaming.fact_state import late_sessions, quarantined, run_fact_state_stream


@pytest.mark.parametrize("stream, batch", [("stream_fact_state", "fact_daily_user_activity"), ("stream_ccu_event_time", "ccu_hourly")])
def test_stream_equals_batch(spark, stream, batch):
    a, b = (sorted(map(tuple, catalog.QUERIES[q](spark, SF_TINY).collect()), key=str) for q in (stream, batch))
    assert a == b and b


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    json_lines(folder / f"{name}.json", *rows)
    time.sleep(0.02)


def fact_run(spark, tmp_path, files=1, **more):
    return run_fact_state_stream(spark, str(tmp_path / "in"), members(spark, ("ann", "NO")), str(tmp_path / "t"),
                                 look_back=timedelta(days=2), max_files_per_trigger=files, **more)


DAY = date(2025, 7, 10)


def test_late_sessions_are_counted_and_merged(spark, tmp_path):
    land(tmp_path / "in", 0, ("ann", "2025-07-10T10:00:00", 1, "tv"), ("ann", "2025-07-10T11:00:00", 1, "tv"), (None, "2025-07-10T10:00:00", 1, "tv"))
    land(tmp_path / "in", 1, ("bob", "2025-07-20T10:00:00", 1, "tv"))
    # Two days before the 20th, 10:00 is just on time; one second earlier is late.
    land(tmp_path / "in", 2, ("cat", "2025-07-18T10:00:00", 1, "tv"), ("cat", "2025-07-18T09:59:59", 1, "tv"), ("dan", "2025-07-18T09:59:59", 1, "tv"),
         ("ann", "2025-07-10T23:00:00", 1, "tv"), ("ann", "2025-07-10T23:00:00", 1, "pc"), '{"user_id": "cut')
    want = {(DAY, "ann", "NO", "tv"), (DAY, "ann", "NO", "pc"), (date(2025, 7, 20), "bob", "UNKNOWN", "tv"),
            (date(2025, 7, 18), "cat", "UNKNOWN", "tv"), (date(2025, 7, 18), "dan", "UNKNOWN", "tv")}
    got = fact_run(spark, tmp_path)
    assert as_set(got) == want and got.count() == 5
    assert as_set(late_sessions(spark, str(tmp_path / "t"))) == {("late", DAY, 2), ("late", date(2025, 7, 18), 2)}
    assert as_set(quarantined(spark, str(tmp_path / "t")), "dq_reason") == {("null_user_id",), ("malformed_record",)}
    # A second start takes up only what is new, knows the keys of the first, and keeps its watermark.
    land(tmp_path / "in", 3, ("bob", "2025-07-20T23:00:00", 1, "tv"), ("eve", "2025-07-20T23:00:00", 1, "tv"), ("ann", "2025-07-10T01:00:00", 1, "tv"))
    got = fact_run(spark, tmp_path)
    assert as_set(got) == want | {(date(2025, 7, 20), "eve", "UNKNOWN", "tv")} and got.count() == 6
    assert ("late", DAY, 3) in as_set(late_sessions(spark, str(tmp_path / "t")))
    assert fact_run(spark, tmp_path).count() == 6  # nothing new


def test_a_day_is_written_as_one_file_however_many_parts_the_state_has(spark, tmp_path):
    """Forty users on each of two days are in every part of the state."""
    land(tmp_path / "in", 0, *((f"u{i}", f"2025-07-{10 + i % 2}T10:00:00", 1, "tv") for i in range(80)))
    assert fact_run(spark, tmp_path).count() == 80
    files = [p.parent.parent.name for p in (tmp_path / "t/fact").rglob("*.parquet")]
    assert sorted(files) == ["activity_date=2025-07-10", "activity_date=2025-07-11"]


def test_a_wrong_clock_does_not_move_the_watermark(spark, tmp_path):
    land(tmp_path / "in", 0, ("bob", "2999-01-01T00:00:00", 1, "tv"))
    land(tmp_path / "in", 1, ("ann", "2025-07-10T10:00:00", 1, "tv"))
    got = fact_run(spark, tmp_path, horizon=datetime(2026, 1, 1))
    assert as_set(got) == {(date(2999, 1, 1), "bob", "UNKNOWN", "tv"), (DAY, "ann", "NO", "tv")}
    assert as_set(late_sessions(spark, str(tmp_path / "t"))) == {("ahead", date(2999, 1, 1), 1)}


def test_interrupted_runs_store_each_key_once(spark, tmp_path, monkeypatch):
    """The stream fails after a micro-batch has been written but not committed, then in the merge of the late sessions."""
    land(tmp_path / "in", 0, ("ann", "2025-07-10T10:00:00", 1, "tv"), ("bob", "2025-07-20T10:00:00", 1, "tv"))
    land(tmp_path / "in", 1, ("cat", "2025-07-01T10:00:00", 1, "tv"), ("ann", "2025-07-10T12:00:00", 1, "tv"))
    write, fail = routing.write_slices, {"batch-0", "side-0-1"}

    def write_then_fail(rows, path, partition_by, load):
        write(rows, path, partition_by, load)
        if load in fail:
            fail.remove(load)
            raise OSError("lost")

    monkeypatch.setattr(routing, "write_slices", write_then_fail)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            fact_run(spark, tmp_path)
    got = fact_run(spark, tmp_path)
    assert as_set(got, "user_id") == {("ann",), ("bob",), ("cat",)} and got.count() == 3


def test_refuses_a_short_look_back_and_a_table_without_state(spark, tmp_path):
    land(tmp_path / "in", 0, ("ann", "2025-07-10T10:00:00", 1, "tv"))
    with pytest.raises(ValueError, match="day or more"):
        run_fact_state_stream(spark, str(tmp_path / "in"), members(spark), str(tmp_path / "t"), look_back=timedelta(hours=5))
    (tmp_path / "t/fact").mkdir(parents=True)
    with pytest.raises(ValueError, match="no state"):
        fact_run(spark, tmp_path)


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert fact_run(spark, tmp_path).count() == 0
    assert run_ccu_hours_stream(spark, str(tmp_path / "in"), str(tmp_path / "c")).count() == 0


def minutes(tmp_path, name, *rows):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{name}.csv").write_text("timestamp,ccu\n" + "\n".join(rows) + "\n")
    time.sleep(0.02)


def test_closed_hours_are_final_and_late_minutes_correct_them(spark, tmp_path):
    base = str(tmp_path / "t")
    run = lambda: run_ccu_hours_stream(spark, str(tmp_path / "in"), base, lateness=timedelta(hours=1), max_files_per_trigger=1)
    hour = lambda h: datetime(2025, 7, 10, h)
    minutes(tmp_path, 0, "2025-07-10T08:10:00,4", "2025-07-10T08:20:00,", "soon,5", "2025-07-10T08:30:00,many")
    minutes(tmp_path, 1, "2025-07-10T12:30:00,10")
    minutes(tmp_path, 2, "2025-07-10T08:40:00,8", "2025-07-10T11:30:00,7", "2025-07-10T12:40:00,20")
    assert as_set(run()) == {(hour(8), 6.0), (hour(11), 7.0), (hour(12), 15.0)}
    assert as_set(rejected_minutes(spark, base)) == {("bad_time",), ("bad_value",)}
    minutes(tmp_path, 3, "2025-07-10T16:00:00,1")
    run()
    files = lambda: {p: p.read_bytes() for p in (tmp_path / "t/hours").rglob("*.parquet")}
    before, until = files(), closed_until(spark, base)
    assert before and until >= hour(9)
    minutes(tmp_path, 4, "2025-07-10T08:50:00,12", "2025-07-10T16:30:00,3", "2025-07-10T02:00:00,9")
    assert as_set(run()) == {(hour(2), 9.0), (hour(8), 8.0), (hour(11), 7.0), (hour(12), 15.0), (hour(16), 2.0)}
    after = files()
    assert all(after[p] == content for p, content in before.items())  # what was closed has not changed
    states = {r.hour: (r.minutes, r.late_minutes, r.is_open) for r in hour_states(spark, base).collect()}
    assert states[hour(2)] == (1, 1, False) and states[hour(8)] == (3, 2, False) and states[hour(16)] == (2, 0, True)
    # Minutes of closed hours are not kept.
    kept = routing.routed(spark, base, "ts timestamp_ntz", routing.ON_TIME)
    assert kept.where("ts < '2025-07-10 08:30:00'").count() == 0 and kept.where("ts >= '2025-07-10 16:00:00'").count() == 2


def test_every_source_file_is_read_once(spark, tmp_path):
    """One scan for all routes: the plan of a micro-batch's write has the source once, and rows of every route come out of it."""
    minutes(tmp_path, 0, "2025-07-10T08:10:00,4", "soon,5")
    run_ccu_hours_stream(spark, str(tmp_path / "in"), str(tmp_path / "t"))
    marks = routing.read_marks(spark, str(tmp_path / "t")).first()
    assert (marks.on_time, marks.late, marks.ahead, marks.rejected) == (1, 0, 0, 1)


def test_preview_counts_small_sets_exactly_and_large_ones_closely(spark, tmp_path):
    base = str(tmp_path / "p")
    run = lambda: run_dau_preview_stream(spark, str(tmp_path / "in"), members(spark, ("ann", "NO")), base, 1)
    land(tmp_path / "in", 0, ("ann", "2025-07-10T10:00:00", 1, "tv"), ("bob", "2025-07-10T10:00:00", 1, "tv"), (None, "2025-07-10T10:00:00", 1, "tv"))
    land(tmp_path / "in", 1, ("ann", "2025-07-10T12:00:00", 1, "pc"), ("ann", "2025-07-11T12:00:00", 1, "pc"))
    assert {r[:4] + (r.dau_preview,) for r in run().collect() if r.level in ("all", "country")} == {
        (DAY, "all", None, None, 2), (date(2025, 7, 11), "all", None, None, 1), (DAY, "country", "NO", None, 1),
        (DAY, "country", "UNKNOWN", None, 1), (date(2025, 7, 11), "country", "NO", None, 1)}
    assert ("all", None, None, 2) in as_set(preview_of_range(spark, base)) and ("platform", None, "pc", 1) in as_set(preview_of_range(spark, base))
    # 60,000 users on one day, a third of them twice: the error that is stated.
    many = spark.range(80_000).selectExpr("concat('u', id % 60000) as user_id", "'2025-08-01T10:00:00' as timestamp", "1.0D as duration", "'tv' as platform")
    many.write.mode("append").json(str(tmp_path / "in"))
    found = {r.activity_date: r.dau_preview for r in run().where("level = 'all'").collect()}
    assert abs(found[date(2025, 8, 1)] - 60_000) <= 0.05 * 60_000 and found[DAY] == 2


def test_published_days_have_few_files_however_many_micro_batches(spark, tmp_path):
    """Twelve micro-batches with sessions of the same day: one file in the table, none left beside it, all rows there. A run that is
    lost after publishing changes nothing when it is run again."""
    table = "fact_of_stream"
    create_published_fact(spark, table, str(tmp_path / "table"))
    try:
        for i in range(12):
            land(tmp_path / "in", i, (f"u{i}", "2025-07-10T10:00:00", 1, "tv"), ("ann", "2025-07-10T10:00:00", 1, "tv"))
        got = fact_run(spark, tmp_path, table=table)
        assert got.count() == 13 and not (tmp_path / "t/fact").exists()
        where = partition_locations(spark, table, [DAY])[DAY].removeprefix("file:")
        assert len(list(Path(where).glob("*.parquet"))) == 1
        land(tmp_path / "in", 20, ("late", "2025-07-01T10:00:00", 1, "tv"), ("u1", "2025-07-10T11:00:00", 1, "tv"))
        (tmp_path / "t/fact").mkdir()
        spark.table(table).withColumn("load", routing.F.lit("again")).write.mode("append").partitionBy("activity_date", "load").parquet(str(tmp_path / "t/fact"))
        got = fact_run(spark, tmp_path, table=table)
        assert got.count() == 14 and got.select("activity_date", "user_id").distinct().count() == 14
        assert partition_locations(spark, table, [DAY])[DAY].removeprefix("file:") == where  # nothing new for that day
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
