"""Parsing and blank rules, table-driven."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.text import is_blank, is_empty
from pulsegrid.functions.timestamps import hour_bucket, parse_event_time, parse_strict_timestamp

LENIENT = [
    ("2026-09-20T10:00:00", datetime(2026, 9, 20, 10, 0)),
    ("2026-09-20 10:00:00", datetime(2026, 9, 20, 10, 0)),
    ("2026-09-20", datetime(2026, 9, 20)),
    ("2026-09-20T10:00:00.250", datetime(2026, 9, 20, 10, 0, 0, 250000)),
    ("  2026-09-20T10:00:00", datetime(2026, 9, 20, 10, 0)),
    ("not-a-date", None),
    ("", None),
    ("2026", None),
    ("2026-09", None),
    ("10:00:00", None),
    ("2026/09/20", None),
    ("2026-13-01T00:00:00", None),
    (None, None),
]


@pytest.mark.parametrize("text,expected", LENIENT)
def test_lenient_parse(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_event_time("s")).first()[0] == expected


STRICT = [
    ("2026-09-20T10:00:00", datetime(2026, 9, 20, 10, 0)),
    ("2026-09-20 10:00:00", None),
    ("2026-09-20T10:00:00Z", None),
    ("2026-09-20T10:00:00.5", None),
    ("2026-09-20", None),
    (None, None),
]


@pytest.mark.parametrize("text,expected", STRICT)
def test_strict_parse(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_strict_timestamp("s")).first()[0] == expected


@pytest.mark.parametrize("text,blank,empty", [
    (None, True, True), ("", True, True), ("  ", True, False), (" ", True, False),
    ("\n", False, False), ("a", False, False), (" a ", False, False),
    ("\u00a0", True, False), (" \u00a0 ", True, False), ("\u3000", True, False), ("\u00a0a", False, False),
    ("a\u00a0", False, False), ("\t", False, False), ("\u00e9", False, False), (" \u00e9", False, False),
])
def test_blank_and_empty(spark, text, blank, empty):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(is_blank("s"), is_empty("s")).first()
    assert (row[0], row[1]) == (blank, empty)


def test_hour_bucket_stays_naive(spark):
    df = spark.createDataFrame([(datetime(2026, 9, 20, 10, 59, 59),)], "ts timestamp_ntz")
    out = df.select(hour_bucket("ts").alias("h"))
    assert dict(out.dtypes)["h"] == "timestamp_ntz"
    assert out.first()[0] == datetime(2026, 9, 20, 10, 0)


def test_session_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    df = spark.createDataFrame([("2026-09-20T23:30:00",)], "s string")
    assert str(df.select(parse_event_time("s").cast("date")).first()[0]) == "2026-09-20"
    assert df.select(F.col("s")).count() == 1


def test_window_bounds_ignore_driver_time_zone(spark, monkeypatch):
    """Bounds are wall-clock literals: a non-UTC driver process must not shift them."""
    import time
    from datetime import date

    from pulsegrid.functions.predicates import event_time_window

    df = spark.createDataFrame([(datetime(2026, 9, 20, 0, 0),), (datetime(2026, 9, 19, 23, 59, 59),)],
                               "ts timestamp_ntz")
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        got = [r[0] for r in df.where(event_time_window("ts", date(2026, 9, 20), date(2026, 9, 21))).collect()]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert got == [datetime(2026, 9, 20, 0, 0)]


# Every string below parses identically in this engine and in DuckDB's TRY_CAST(... AS TIMESTAMP),
# except the documented differences.
PROBE_STRINGS = [
    "2026-09-20T10:00:00", "2026-09-20 10:00:00", "2026-09-20", "2026-09-20T10:00", "2026-09-20T10:00:00.123",
    "2026-09-20T10:00:00Z", "2026-09-20T10:00:00+02:00", "2026-9-2T1:2:3", "2026-9-2", "not-a-date", "", " ",
    "2026", "2026-09", "10:00:00", "2026/09/20", "20260920", "2026-13-01", "2026-02-30", "epoch", "infinity",
    "2026-09-20T24:00:00", "12026-09-20", " 2026-09-20T10:00:00", "2026-09-20 ", "2026-09-20T10:00:00 ", "today",
    "2026-09-20T10:00:00.123456", "0001-01-01", "9999-12-31T23:59:59", "2026-09-20T10", "2026-09-20 10:00:00.5",
]
DOCUMENTED_DIFFERENCES = {"2026/09/20", "epoch", "infinity", "2026-09-20T24:00:00", "12026-09-20", "2026-09-20 ",
                          "2026-09-20T10"}


def test_lenient_parse_agrees_with_duckdb_except_documented(spark):
    import duckdb

    got = {r[0]: r[1] for r in spark.createDataFrame([(s,) for s in PROBE_STRINGS], "s string")
           .select("s", parse_event_time("s")).collect()}
    con = duckdb.connect()
    differ = {s for s in PROBE_STRINGS if con.execute("SELECT TRY_CAST(? AS TIMESTAMP)", [s]).fetchone()[0] != got[s]}
    assert differ == DOCUMENTED_DIFFERENCES
