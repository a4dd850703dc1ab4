"""The grain of the fact, the country of a user, and distinct-user figures on it."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import as_set, json_lines, members, visits

from pulsegrid.operators import metrics
from pulsegrid.operators.activity import build_fact, grain_check
from pulsegrid.operators.tables import read_fact_if_exists, upsert_fact

FRI, SAT, MON = date(2025, 7, 4), date(2025, 7, 5), date(2025, 7, 7)


def at(day, clock="12:00:00"):
    return f"{day.isoformat()}T{clock}"


# Three people over a weekend: kim on two devices, lou on one every day, pat without an account.
WEEKEND = [
    ("kim", at(FRI, "00:00:00"), 3.0, "tv"), ("kim", at(FRI, "23:59:59"), 4.0, "tv"), ("kim", at(FRI), 5.0, "phone"),
    ("lou", at(FRI), 1.0, "phone"), ("lou", at(SAT), 1.0, "phone"), ("lou", at(MON), 1.0, "phone"),
    ("pat", at(SAT), 1.0, "tv"), ("pat", at(SAT), None, "tv"), ("pat", at(SAT), -2.0, "phone"),
]


@pytest.fixture(scope="module")
def fact(spark):
    return build_fact(visits(spark, *WEEKEND), members(spark, ("kim", "NO"), ("lou", "PT"), ("unused", "IS")))


def test_one_row_for_each_day_user_and_platform(fact):
    assert as_set(fact) == {
        (FRI, "kim", "NO", "tv"), (FRI, "kim", "NO", "phone"), (FRI, "lou", "PT", "phone"), (SAT, "lou", "PT", "phone"),
        (MON, "lou", "PT", "phone"), (SAT, "pat", "UNKNOWN", "tv")}
    check = grain_check(fact).first()
    assert check["is_unique"] and check["fact_rows"] == check["distinct_keys"] == 6


@pytest.mark.parametrize("figure, want", [
    (metrics.dau_daily, {(FRI, 2), (SAT, 2), (MON, 1)}),
    (metrics.dau_total, {(3,)}),
    (metrics.dau_avg_daily, {(5 / 3, 3)}),
    (lambda f: metrics.dau_by(f, "platform"), {("tv", 2), ("phone", 2)}),
    (lambda f: metrics.dau_by(f, "country"), {("NO", 1), ("PT", 1), ("UNKNOWN", 1)}),
    (lambda f: metrics.dau_by(f, "country", exclude_unknown=True), {("NO", 1), ("PT", 1)}),
    (lambda f: metrics.unknown_users(f), {(1,)}),
    (lambda f: metrics.dau_daily(f, SAT, MON), {(SAT, 2), (MON, 1)}),
    (lambda f: metrics.dau_daily(f, country="PT"), {(FRI, 1), (SAT, 1), (MON, 1)}),
    (lambda f: metrics.dau_daily(f, platform="tv"), {(FRI, 1), (SAT, 1)}),
    (lambda f: metrics.last_n_days(f, 2), {(SAT, 2), (MON, 1)}),
    (lambda f: metrics.top_n_countries(f, 2), {("NO", 1), ("PT", 1)}),
])
def test_figures_count_people_once(fact, figure, want):
    assert as_set(figure(fact)) == want


def test_figures_of_nobody(spark):
    empty = build_fact(visits(spark), members(spark))
    assert metrics.dau_daily(empty).count() == 0
    assert metrics.dau_avg_daily(empty).first()["avg_daily_dau"] == 0.0


@pytest.mark.parametrize("accounts, country", [
    ([], "UNKNOWN"),
    ([("kim", None)], "UNKNOWN"),
    ([("kim", "NO")], "NO"),
    ([("kim", "NO", "2025-01-01T00:00:00"), ("kim", "SE", "2025-06-01T00:00:00")], "SE"),
    ([("kim", "NO"), ("kim", "DK")], "DK"),
    ([("Kim", "NO")], "UNKNOWN"),
])
def test_country_comes_from_the_latest_account(spark, accounts, country):
    fact = build_fact(visits(spark, ("kim", at(FRI), 1.0, "tv")), members(spark, *accounts))
    assert as_set(fact, "country") == {(country,)}


def test_a_load_can_be_repeated(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    for _ in range(3):
        upsert_fact(spark, fact, path)
        assert as_set(read_fact_if_exists(spark, path)) == as_set(fact)


def test_two_call_interface(spark, tmp_path):
    from pulsegrid.api import query_dau, transform

    accounts = tmp_path / "accounts.csv"
    accounts.write_text("user_id,country,created_at,updated_at\nkim,NO,2025-01-01T00:00:00,2025-01-01T00:00:00\n")
    sessions = json_lines(tmp_path / "visits.json", *WEEKEND, (None, at(FRI), 1.0, "tv"))
    out = transform(spark, str(accounts), sessions, fact_path=str(tmp_path / "fact"))
    report = out.report.first()
    assert (report["sessions_loaded"], report["sessions_quarantined"], report["fact_rows"], report["distinct_users"]) == (10, 2, 6, 3)
    dau = query_dau(out.fact)
    assert as_set(dau.daily) == {(FRI, 2), (SAT, 2), (MON, 1)}
    assert as_set(dau.by_country) == {("NO", 1), ("UNKNOWN", 2)}
    assert dau.total.first()[0] == 3
