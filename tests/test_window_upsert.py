"""Extraction window, look-back, account reduction and the two upsert modes."""

import re
from datetime import date

import pytest
from conftest import as_set, json_lines, members, visits

from pulsegrid.config import JobConfig, Window, check_table_name
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.activity import build_fact
from pulsegrid.operators.tables import append_new_keys, merge_rows, read_fact_if_exists, replace_rows, upsert_fact
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS
from pulsegrid.sources.readers import read_sessions_json


def test_window_arithmetic():
    w = Window(end_date="2025-03-23", reprocess_days=7)
    assert w.start_date == date(2025, 2, 22)  # end - 29 days
    assert w.extract_start == date(2025, 2, 15)
    assert w.extract_end == date(2025, 3, 24)  # end inclusive -> exclusive end + 1
    w0 = Window(end_date=date(2025, 3, 23), start_date=date(2025, 3, 20), reprocess_days=0)
    assert (w0.extract_start, w0.extract_end) == (date(2025, 3, 20), date(2025, 3, 24))
    with pytest.raises(ValueError):
        Window(end_date="2025-03-23", reprocess_days=-1)


def test_config_from_env_precedence():
    env = {"PULSEGRID_END_DATE": "2025-03-23", "PULSEGRID_REPROCESS_DAYS": "3"}
    cfg = JobConfig.from_env(env)
    assert cfg.window.reprocess_days == 3 and cfg.window.end_date == date(2025, 3, 23)
    cfg = JobConfig.from_env(env, end_date="2025-03-30", reprocess_days=0)
    assert cfg.window.end_date == date(2025, 3, 30) and cfg.window.reprocess_days == 0
    assert JobConfig.from_env({**env, "PULSEGRID_JDBC_URL": "jdbc:x"}).accounts_format == "jdbc"


def test_table_name_guard():
    assert check_table_name("accounts_v2") == "accounts_v2"
    for bad in ["accounts; drop table x", "1abc", "a.b", ""]:
        with pytest.raises(ValueError):
            check_table_name(bad)


DAY = "2025-07-{:02d}T{}".format


def test_window_keeps_its_days_and_what_has_no_time(spark, tmp_path):
    path = json_lines(
        tmp_path / "raw.json",
        ("z", DAY(9, "23:59:59"), 1, "tv"), ("z", DAY(10, "00:00:00"), 1, "tv"), ("z", DAY(12, "23:59:59"), 1, "tv"),
        ("z", DAY(13, "00:00:00"), 1, "tv"), ("z", "some day", 1, "tv"), ("z", None, 1, "tv"))
    got = read_sessions_json(spark, path, Window("2025-07-12", "2025-07-10", 0))
    assert as_set(got, "timestamp") == {(DAY(10, "00:00:00"),), (DAY(12, "23:59:59"),), ("some day",), (None,)}


@pytest.mark.parametrize("look_back, rows", [(0, 1), (2, 2), (30, 3)])
def test_look_back_widens_the_window(spark, tmp_path, look_back, rows):
    path = json_lines(tmp_path / "raw.json", *(("z", DAY(d, "08:00:00"), 1, "tv") for d in (1, 8, 10)))
    assert read_sessions_json(spark, path, Window("2025-07-10", "2025-07-10", look_back)).count() == rows


def test_latest_account_per_user(spark):
    accounts = members(
        spark,
        ("newer", "NO", "2024-05-01T00:00:00"), ("newer", "SE", "2024-05-02T00:00:00"),
        ("tied", "PT", "2024-05-01T00:00:00"), ("tied", "ES", "2024-05-01T00:00:00"),
        ("blank", None, "2024-05-01T00:00:00"), ("blank", "IS", "2024-05-01T00:00:00"),
        ("odd", "FI", "last spring"), ("odd", "EE", "2001-01-01T00:00:00"), (None, "LV"))
    assert as_set(latest_account_per_user(accounts), "user_id", "country") == {
        ("newer", "SE"), ("tied", "ES"), ("blank", "IS"), ("odd", "EE")}


def facts(spark, accounts, *rows):
    """Fact rows from (user, day) pairs."""
    return build_fact(visits(spark, *((u, DAY(d, "09:00:00"), 1.0, "tv") for u, d in rows)), members(spark, *accounts))


def table(spark, path):
    return {(r["user_id"], r["activity_date"].day): r["country"] for r in read_fact_if_exists(spark, path).collect()}


@pytest.mark.parametrize("mode, kept", [("replace", "SE"), ("insert_only", "NO")])
def test_modes_differ_in_who_wins(spark, tmp_path, mode, kept):
    path = str(tmp_path / "fact")
    upsert_fact(spark, facts(spark, [("ann", "NO"), ("bob", "NO")], ("ann", 1), ("bob", 2)), path, mode=mode)
    upsert_fact(spark, facts(spark, [("ann", "SE")], ("ann", 1), ("cat", 1)), path, mode=mode)
    assert table(spark, path) == {("ann", 1): kept, ("bob", 2): "NO", ("cat", 1): "UNKNOWN"}


@pytest.mark.parametrize("mode", ["replace", "insert_only"])
def test_days_far_apart_lose_nothing(spark, tmp_path, mode):
    """A batch may reach any dates: rows of every date in the table stay."""
    path = str(tmp_path / "fact")
    upsert_fact(spark, facts(spark, [], ("ann", 1), ("bob", 1), ("ann", 9), ("ann", 15)), path, mode=mode)
    upsert_fact(spark, facts(spark, [], ("cat", 1), ("cat", 15), ("cat", 20)), path, mode=mode)
    assert sorted(table(spark, path)) == [("ann", 1), ("ann", 9), ("ann", 15), ("bob", 1), ("cat", 1), ("cat", 15), ("cat", 20)]


def test_empty_batches_and_absent_tables(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert read_fact_if_exists(spark, path).count() == 0
    upsert_fact(spark, facts(spark, []), path)
    assert read_fact_if_exists(spark, path).count() == 0
    upsert_fact(spark, facts(spark, [], ("ann", 1)), path)
    upsert_fact(spark, facts(spark, []), path)
    assert table(spark, path) == {("ann", 1): "UNKNOWN"}


def test_unknown_mode(spark):
    f = facts(spark, [])
    with pytest.raises(ValueError):
        merge_rows(f, f, "upsert_everything")


@pytest.mark.parametrize("mode", ["replace", "insert_only"])
def test_a_load_reads_its_sources_once(spark, tmp_path, mode):
    path = str(tmp_path / "fact")
    upsert_fact(spark, facts(spark, [], ("ann", 1), ("ann", 2)), path)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = facts(spark, [], ("bob", 1), ("cat", 2), ("ann", 9))
    upsert_fact(spark, batch.mapInArrow(counted, batch.schema), path, mode=mode)
    assert seen.value == 3 and len(table(spark, path)) == 5


@pytest.mark.parametrize("load", ["replace", "insert_only", "replace_rows", "append_new_keys"])
def test_no_task_holds_all_keys_of_a_load(spark, tmp_path, monkeypatch, load):
    """Keys of few distinct values are small as files and large as rows: they are joined by sorting, not by a broadcast."""
    keys = "date'2025-07-10' + cast(id % 3 as int) as activity_date, cast(id as string) as user_id, 'NO' as country, 'tv' as platform"
    first, second = (spark.range(a, b).selectExpr(*keys.split(", ")) for a, b in ((0, 600), (300, 900)))
    paths = [str(tmp_path / name) for name in ("old", "new")]
    first.write.partitionBy("activity_date").parquet(paths[0])
    second.write.parquet(paths[1])
    old, new = (spark.read.parquet(p).select(*FACT_COLUMNS) for p in paths)
    plans, join = [], type(old).join

    def seen(self, other, on=None, how=None):
        joined = join(self, other, on, how)
        if how == "left_anti":
            plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(type(old), "join", seen)
    if load == "replace_rows":
        replace_rows(spark, new, paths[0], FACT_KEYS, "activity_date")
        got = spark.read.parquet(paths[0])
    elif load == "append_new_keys":
        append_new_keys(spark, new, paths[0], FACT_KEYS, "activity_date")
        got = spark.read.parquet(paths[0])
    else:
        got = merge_rows(new, old, load)
    assert got.count() == 900 and got.select("user_id").distinct().count() == 900
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and not re.search("BroadcastHashJoin.*LeftAnti", plans[0])
