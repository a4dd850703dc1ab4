"""Hourly concurrent users: the mean of what was measured, and the busiest hour."""

from __future__ import annotations

import math
from datetime import datetime

import pytest

from pulsegrid.operators.ccu import ccu_peak, hourly_ccu


def clock(hour, minute=0):
    return datetime(2025, 7, 4, hour, minute)


def measured(spark, *rows):
    return spark.createDataFrame(list(rows), "ts timestamp_ntz, ccu double")


# minutes of one hour -> mean
MEANS = [
    ([7.0], 7.0),
    ([1.0, 2.0, 6.0], 3.0),
    ([5.0, None, 6.0], 5.5),
    ([None], None),
    ([0.1] * 10, 0.1),
    ([float("nan"), 4.0, 6.0], float("nan")),
    ([float("nan")], float("nan")),
    ([float("inf"), 1.0], float("inf")),
]


@pytest.mark.parametrize("values, mean", MEANS)
def test_mean_of_an_hour(spark, values, mean):
    got = hourly_ccu(measured(spark, *((clock(3, m), v) for m, v in enumerate(values)))).collect()
    assert len(got) == 1 and got[0]["hour"] == clock(3)
    if mean is not None and math.isnan(mean):
        assert math.isnan(got[0]["avg_ccu"])
    else:
        assert got[0]["avg_ccu"] == mean


def test_hours_do_not_mix_and_come_in_order(spark):
    df = measured(spark, (clock(22), 8.0), (clock(21, 59), 1.0), (clock(21), 3.0), (clock(23, 30), 9.0))
    out = hourly_ccu(df)
    assert [tuple(r) for r in out.collect()] == [(clock(21), 2.0), (clock(22), 8.0), (clock(23), 9.0)]
    assert out.dtypes == [("hour", "timestamp_ntz"), ("avg_ccu", "double")]


@pytest.mark.parametrize("start, end, hours", [
    (None, None, [4, 5, 6]), (clock(5), None, [5, 6]), (None, clock(5), [4, 5]), (clock(5), clock(5), [5]), (clock(7), None, [])])
def test_both_ends_of_a_range_count(spark, start, end, hours):
    df = measured(spark, *((clock(h), float(h)) for h in (4, 5, 6)))
    assert [r["hour"].hour for r in hourly_ccu(df, start, end).collect()] == hours


def test_busiest_hour_is_the_first_at_one_decimal(spark):
    df = measured(spark, (clock(9), 71.36), (clock(17), 71.44), (clock(12), 70.0))
    assert tuple(ccu_peak(hourly_ccu(df)).first()) == (clock(9), "09:00", 71.4)
