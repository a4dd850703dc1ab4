"""Streams: whatever the order and size of the micro-batches, the result is the batch result."""

from __future__ import annotations

import time
from datetime import date, datetime

import pytest
from conftest import SF_TINY, as_set, json_lines, members

from pulsegrid.plans import catalog
from pulsegrid.streaming.ccu_stream import run_ccu_stream
from pulsegrid.streaming.dau_stream import run_dau_stream
from pulsegrid.streaming.fact_stream import run_fact_stream


@pytest.mark.parametrize("stream, batch", [
    ("stream_fact", "fact_daily_user_activity"), ("stream_dau", "dau_daily"), ("stream_quarantine", "dq_quarantined_sessions")])
def test_stream_equals_batch(spark, stream, batch):
    a, b = (sorted(map(tuple, catalog.QUERIES[q](spark, SF_TINY).collect()), key=str) for q in (stream, batch))
    assert a == b and b


def test_ccu_stream_equals_batch(spark):
    a, b = (sorted(map(tuple, catalog.QUERIES[q](spark, SF_TINY).collect())) for q in ("stream_ccu_hourly", "ccu_hourly"))
    assert a == b and b


# One file a micro-batch: a day, a far future day, then days long before both.
FILES = [
    [("ann", "2025-07-10T10:00:00", 1, "tv")],
    [("bob", "2999-01-01T00:00:00", 1, "tv"), (None, "2025-07-10T10:00:00", 1, "tv")],
    [("cat", "2025-07-10T11:00:00", 1, "tv"), ("ann", "2025-07-10T12:00:00", 1, "tv")],
    [("dan", "2024-01-01T00:00:00", 1, "tv"), '{"user_id": "cut'],
]
FACT = {(date(2025, 7, 10), "ann", "NO", "tv"), (date(2999, 1, 1), "bob", "UNKNOWN", "tv"),
        (date(2025, 7, 10), "cat", "UNKNOWN", "tv"), (date(2024, 1, 1), "dan", "UNKNOWN", "tv")}


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(FILES):
        json_lines(tmp_path / "in" / f"{i}.json", *rows)
        time.sleep(0.02)
    return tmp_path / "in"


@pytest.mark.parametrize("files, mode", [(1, "insert_only"), (1, "replace"), (100, "insert_only")])
def test_no_session_is_too_late(spark, landing, tmp_path, files, mode):
    paths = {"fact_path": str(tmp_path / "fact"), "checkpoint": str(tmp_path / "ckpt"), "quarantine_path": str(tmp_path / "bad")}
    run = lambda: run_fact_stream(spark, str(landing), members(spark, ("ann", "NO")), max_files_per_trigger=files, mode=mode, **paths)
    assert as_set(run()) == FACT
    assert as_set(spark.read.parquet(paths["quarantine_path"]), "dq_reason") == {("null_user_id",), ("malformed_record",)}
    # A second start takes up only what is new, and a key that is stored stays one row.
    json_lines(landing / "9.json", ("ann", "2025-07-10T23:00:00", 1, "tv"), ("eve", "2025-07-09T23:00:00", 1, "tv"))
    got = run()
    assert as_set(got) == FACT | {(date(2025, 7, 9), "eve", "UNKNOWN", "tv")} and got.count() == 5


@pytest.mark.parametrize("files", [1, 100])
def test_dau_of_all_days(spark, landing, tmp_path, files):
    got = run_dau_stream(spark, str(landing), table_path=str(tmp_path / "dau"), checkpoint=str(tmp_path / "c"), max_files_per_trigger=files)
    assert as_set(got) == {(date(2025, 7, 10), 2), (date(2999, 1, 1), 1), (date(2024, 1, 1), 1)}


@pytest.mark.parametrize("files", [1, 100])
def test_ccu_files_in_any_order(spark, tmp_path, files):
    (tmp_path / "in").mkdir()
    parts = [["2025-07-10T20:00:00,4"], ["2025-07-10T15:00:00,6", "2025-07-10T20:30:00,8"], ["2025-07-10T08:00:00,1", "soon,5"],
             ["2025-07-10T09:10:00,2", "2025-07-10T09:20:00,many", "2025-07-10T09:30:00,"]]
    for i, rows in enumerate(parts):
        (tmp_path / "in" / f"{i}.csv").write_text("timestamp,ccu\n" + "\n".join(rows) + "\n")
        time.sleep(0.02)
    out = run_ccu_stream(spark, str(tmp_path / "in"), table_path=str(tmp_path / "t"), checkpoint=str(tmp_path / "c"), max_files_per_trigger=files)
    assert as_set(out) == {(datetime(2025, 7, 10, h), v) for h, v in ((8, 1.0), (9, 2.0), (15, 6.0), (20, 6.0))}
    assert as_set(spark.read.parquet(str(tmp_path / "t/rejected")), "reject") == {("bad_time",), ("bad_value",)}
