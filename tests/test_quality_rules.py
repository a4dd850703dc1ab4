"""The quality rules, row by row: which reason a raw session gets, and how reasons are counted."""

from __future__ import annotations

import pytest
from conftest import visits

from pulsegrid.operators import quality

MOMENT = "2025-07-04T18:30:00"
OK = None

# (user, time, seconds, platform) -> reason
CASES = [
    (("nora", MOMENT, 12.5, "web"), OK),
    (("nora", MOMENT, 0.0, "web"), OK),
    (("nora", MOMENT, None, "web"), OK),
    (("nora", MOMENT, float("nan"), "web"), OK),
    (("nora", "2025-07-04 18:30:00", 1.0, "web"), OK),
    (("nora", "2025-07-04", 1.0, "web"), OK),
    ((None, MOMENT, 1.0, "web"), "null_user_id"),
    (("", MOMENT, 1.0, "web"), "null_user_id"),
    (("   ", MOMENT, 1.0, "web"), "null_user_id"),
    (("nora", None, 1.0, "web"), "null_timestamp"),
    (("nora", "", 1.0, "web"), "invalid_timestamp"),
    (("nora", "yesterday", 1.0, "web"), "invalid_timestamp"),
    (("nora", "2025-02-30T00:00:00", 1.0, "web"), "invalid_timestamp"),
    (("nora", "2025", 1.0, "web"), "invalid_timestamp"),
    (("nora", MOMENT, 1.0, None), "null_platform"),
    (("nora", MOMENT, 1.0, " "), "null_platform"),
    (("nora", MOMENT, -0.001, "web"), "negative_duration"),
    # Several faults at once: the first rule in canonical order names the row.
    ((None, None, -1.0, None), "null_user_id"),
    (("nora", None, -1.0, None), "null_timestamp"),
    (("nora", "soon", -1.0, None), "invalid_timestamp"),
    (("nora", MOMENT, -1.0, None), "null_platform"),
]


@pytest.fixture(scope="module")
def classified(spark):
    return quality.classify_sessions(visits(spark, *(row for row, _ in CASES)))


def test_every_row_gets_its_reason(classified):
    got = [r["dq_reason"] for r in classified.collect()]
    assert got == [reason for _, reason in CASES]


def test_split_is_complete(classified):
    bad = sum(reason is not None for _, reason in CASES)
    assert quality.quarantined_sessions(classified).count() == bad
    assert quality.valid_sessions(classified).count() == len(CASES) - bad
    totals = quality.quality_totals(classified).first()
    assert (totals["sessions_loaded"], totals["sessions_valid"], totals["sessions_quarantined"]) == (len(CASES), len(CASES) - bad, bad)
    for reason in {r for _, r in CASES if r}:
        assert totals[f"q_{reason}"] == sum(r == reason for _, r in CASES)


def test_reasons_by_count_then_rule_order(spark):
    rows = [("ola", MOMENT, -s, "tv") for s in (1.0, 2.0, 3.0)]
    rows += [("ola", "?", 1.0, "tv"), ("", MOMENT, 1.0, "tv"), ("ola", MOMENT, 1.0, "tv")]
    counts = quality.quarantine_counts(quality.classify_sessions(visits(spark, *rows))).collect()
    assert [tuple(r) for r in counts] == [("negative_duration", 3), ("null_user_id", 1), ("invalid_timestamp", 1)]


def test_staging_view_and_strict_rule_differ_where_stated(spark):
    rows = [
        ("nora", MOMENT, 5.0, "web"),  # both
        ("", MOMENT, 5.0, "web"),  # the view keeps blanks
        ("nora", "2025-07-04 18:30:00", 5.0, "web"),  # the view parses leniently
        ("nora", MOMENT, None, "web"),  # neither
        ("nora", "never", 5.0, "web"),  # neither
        (" ", MOMENT, 5.0, "web"),  # both: the strict rule does not trim
    ]
    raw = visits(spark, *rows)
    assert quality.staging_view(raw).count() == 4
    assert quality.strict_valid_sessions(raw).count() == 2
