"""Cube, axis ranges and KPIs (the dashboard semantics)."""

import re
from datetime import date

from pyspark.sql import functions as F

from pulsegrid.operators import cubes


def _fact(spark, rows):
    return spark.createDataFrame(rows, "activity_date date, user_id string, country string, platform string")


D = date
# Axis has a gap: the 3rd and 4th have no data.
ROWS = [
    (D(2026, 9, 1), "a", "DE", "W"), (D(2026, 9, 1), "b", "US", "W"), (D(2026, 9, 1), "b", "US", "A"),
    (D(2026, 9, 2), "a", "DE", "A"),
    (D(2026, 9, 5), "a", "DE", "W"), (D(2026, 9, 5), "c", "UNKNOWN", "W"),
    (D(2026, 9, 6), "b", "US", "W"),
]


def _bounds(b):
    r = b.first()
    return r["lo"], r["hi"]


def test_cube_levels_are_exact(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    rows = {(r["activity_date"], r["level"], r["country"], r["platform"]): r["dau"] for r in cube.collect()}
    assert rows[(D(2026, 9, 1), "day", None, None)] == 2           # b counted once across platforms
    assert rows[(D(2026, 9, 1), "day_platform", None, "W")] == 2
    assert rows[(D(2026, 9, 1), "day_country", "US", None)] == 1
    assert rows[(D(2026, 9, 1), "day_country_platform", "US", "A")] == 1
    assert len([k for k in rows if k[1] == "day"]) == 4


def test_axis_ranges(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    assert _bounds(cubes.axis_range_all(cube)) == (D(2026, 9, 1), D(2026, 9, 6))
    assert _bounds(cubes.axis_range_last_n(cube, 3)) == (D(2026, 9, 2), D(2026, 9, 6))  # axis days, not calendar
    assert _bounds(cubes.axis_range_last_n(cube, 99)) == (D(2026, 9, 1), D(2026, 9, 6))
    # a range inside the gap selects its two neighbours (swap)
    assert _bounds(cubes.axis_range_custom(cube, D(2026, 9, 3), D(2026, 9, 4))) == (D(2026, 9, 2), D(2026, 9, 5))
    # fallbacks: from after the last date -> first axis date; to before the first -> last axis date
    assert _bounds(cubes.axis_range_custom(cube, D(2026, 12, 1), None)) == (D(2026, 9, 1), D(2026, 9, 6))
    assert _bounds(cubes.axis_range_custom(cube, None, D(2026, 1, 1))) == (D(2026, 9, 1), D(2026, 9, 6))


def test_kpis_zero_fill_and_ties(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    k = cubes.kpis_by_slice(cube, cubes.axis_range_all(cube))
    by = {(r["level"], r["country"], r["platform"]): r for r in k.collect()}
    total = by[("day", None, None)]
    assert total["n_days"] == 4 and total["player_days"] == 2 + 1 + 2 + 1
    assert total["avg_dau"] == 6 / 4
    assert (total["peak_dau"], total["peak_date"]) == (2, D(2026, 9, 5))  # tie 2 on 1st and 5th -> latest
    de = by[("day_country", "DE", None)]
    assert de["avg_dau"] == 3 / 4  # absent day counts as zero
    # a slice with no data in range: peak 0 on the last day of the range
    k2 = cubes.kpis_by_slice(cube, cubes.axis_range_last_n(cube, 1))
    unk = {(r["level"], r["country"], r["platform"]): r for r in k2.collect()}[("day_country", "UNKNOWN", None)]
    assert (unk["peak_dau"], unk["peak_date"], unk["avg_dau"], unk["player_days"]) == (0, D(2026, 9, 6), 0.0, 0)


def test_avg_by_country_drops_zero_and_unknown(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    got = cubes.avg_dau_by_country(cube, cubes.axis_range_last_n(cube, 1)).collect()
    assert [(r["platform_filter"], r["country"], r["avg_dau"]) for r in got] == [
        (None, "US", 1.0), ("W", "US", 1.0)]


def test_platforms_of_a_chosen_country_are_zero_filled(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    last = cubes.axis_range_last_n(cube, 1)  # 6 September: only b, US, W
    assert [tuple(r) for r in cubes.avg_dau_by_platform_in(cube, last, "US").collect()] == [("W", 2, 1.0), ("A", 1, 0.0)]
    assert [tuple(r) for r in cubes.avg_dau_by_platform_in(cube, last, "DE", ["Z", "W"]).collect()] == [("Z", 1, 0.0), ("W", 2, 0.0)]
    assert {tuple(r) for r in cubes.avg_dau_by_platform(cube, last).collect()} == {(None, "W", 1.0), ("US", "W", 1.0)}


def test_slice_without_data_is_all_zero(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    r = cubes.kpis_of_slice(cube, cubes.axis_range_all(cube), "XX", "Z").first()
    assert (r["n_days"], r["avg_dau"], r["peak_dau"], r["peak_date"], r["player_days"]) == (4, 0.0, 0, D(2026, 9, 6), 0)
    r = cubes.kpis_of_slice(cube, cubes.axis_range_all(cube), "All", "W").first()
    assert (r["avg_dau"], r["peak_dau"], r["peak_date"], r["player_days"]) == (1.25, 2, D(2026, 9, 5), 5)


def test_dense_series_and_export(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    dense = cubes.dense_series(cube, "country")
    assert dense.count() == 3 * 4
    unk = [r["dau"] for r in dense.where(F.col("country") == "UNKNOWN").orderBy("activity_date").collect()]
    assert unk == [0, 0, 1, 0]
    exp = {(r["level"], r["country"], r["platform"]): r["series"] for r in cubes.cube_export_rows(cube).collect()}
    assert exp[("day", None, None)] == [2, 1, 2, 1]
    assert exp[("day_country", "UNKNOWN", None)] == [0, 0, 1, 0]


def test_allow_list_and_meta(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    got = [(r["country"], r["position"]) for r in cubes.country_allow_list(cube, ["US", "XX", "DE"]).collect()]
    assert got == [("US", 1), ("DE", 2)]
    assert [r["country"] for r in cubes.country_allow_list(cube).collect()] == ["DE", "US"]
    m = cubes.axis_meta(_fact(spark, ROWS)).first()
    assert (m["n_days"], m["total_users"], m["unknown_users"], m["span_years"]) == (4, 3, 1, 0.0)


def test_avg_by_country_ties_follow_allow_list(spark):
    rows = [(D(2026, 9, 1), "a", "US", "W"), (D(2026, 9, 1), "b", "DE", "W")]
    cube = cubes.build_cube(_fact(spark, rows))
    got = cubes.avg_dau_by_country(cube, cubes.axis_range_all(cube), ["US", "DE"]).collect()
    assert [(r["platform_filter"], r["country"]) for r in got] == [(None, "US"), (None, "DE"), ("W", "US"), ("W", "DE")]


def test_slice_series_zero_fills_axis_days(spark):
    cube = cubes.build_cube(_fact(spark, ROWS))
    got = [(r["activity_date"], r["dau"]) for r in
           cubes.slice_series(cube, cubes.axis_range_all(cube), "US", "W").collect()]
    assert got == [(D(2026, 9, 1), 1), (D(2026, 9, 2), 0), (D(2026, 9, 5), 0), (D(2026, 9, 6), 1)]
    got = [r["dau"] for r in cubes.slice_series(cube, cubes.axis_range_last_n(cube, 2), "All", "All").collect()]
    assert got == [2, 1]


def test_a_range_prunes_the_stored_cube(spark, tmp_path):
    from pulsegrid.plans.cube_build import refresh_cube

    cube = refresh_cube(spark, _fact(spark, ROWS), str(tmp_path / "cube"))
    bounds = cubes.axis_range_custom(cube, D(2026, 9, 2), D(2026, 9, 5))
    for figures in (cubes.kpis_by_slice(cube, bounds), cubes.kpis_of_slice(cube, bounds, "DE"), cubes.avg_dau_by_platform(cube, bounds)):
        plan = figures._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*>= 2026-09-02", plan), plan
