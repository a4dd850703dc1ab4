"""Numbers in order without a single task, and the exact bitmaps that rest on them."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import SF_TINY, as_set

from pulsegrid.operators import bitmaps
from pulsegrid.operators.numbering import number_rows
from pulsegrid.plans import catalog


@pytest.mark.parametrize("start", [1, 100])
def test_numbers_follow_the_order(spark, start):
    df = spark.range(0, 5000, numPartitions=9).selectExpr("concat('n', lpad(cast((id * 7919) % 5000 as string), 5, '0')) as name", "id as other")
    got = number_rows(df, ["name"], start).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.position)] == sorted(r.name for r in got)
    assert sorted(r.position for r in got) == list(range(start, start + 5000))
    assert number_rows(df.limit(0), ["name"]).count() == 0


@pytest.mark.parametrize("query", ["country_list_default", "cube_export_lists", "country_allow_list"])
def test_no_list_passes_through_one_task(spark, query):
    plan = catalog.QUERIES[query](spark, SF_TINY)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_ordinals_stay_and_more_than_one_bucket(spark, tmp_path):
    """40,000 users, two buckets; new users get the next ordinals, and a change of country changes its day only."""
    base, day = str(tmp_path / "b"), date(2025, 7, 1)
    fact = spark.range(40_000).selectExpr(f"date'{day}' as activity_date", "concat('u', id) as user_id", "if(id % 3 = 0, 'NO', 'SE') as country", "'tv' as platform")
    b = bitmaps.refresh_bitmaps(spark, fact, base)
    assert as_set(bitmaps.users_by(b, "country")) == {("SE", 26_666), ("NO", 13_334)} and b.select("bucket").distinct().count() == 2
    before = as_set(bitmaps.read_users(spark, base))
    later = spark.range(39_990, 40_010).selectExpr("date'2025-07-02' as activity_date", "concat('u', id) as user_id", "'NO' as country", "'pc' as platform")
    b = bitmaps.refresh_bitmaps(spark, fact.unionByName(later), base, [date(2025, 7, 2)])
    users = as_set(bitmaps.read_users(spark, base))
    assert before < users and {o for _, o in users} == set(range(1, 40_011))
    assert as_set(bitmaps.distinct_users(b)) == {(40_010,)} and as_set(bitmaps.distinct_users(b, platform="pc")) == {(20,)}
    no = 13_334 + 20 - len([i for i in range(39_990, 40_000) if i % 3 == 0])
    assert as_set(bitmaps.users_by(b, "country")) == {("SE", 26_666), ("NO", no)}
    assert as_set(bitmaps.distinct_users(b, day, day, "NO", "tv")) == {(13_334,)}
