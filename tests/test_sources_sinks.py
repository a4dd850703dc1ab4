"""Readers, sinks and the E2/E3 jobs."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, as_set, json_lines, members, visits
from pulsegrid.config import JobConfig, Window
from pulsegrid.operators.quality import classify_sessions
from pulsegrid.operators.tables import create_fact_table, write_fact
from pulsegrid.plans.cube_build import build_cubes
from pulsegrid.plans.daily_activity import quality_report
from pulsegrid.plans.hourly_ccu import run_hourly_ccu
from pulsegrid.sources import fixtures, readers, sinks


def test_quality_report_json_has_ordered_quarantine_map(spark, tmp_path):
    moment = "2025-07-04T10:00:00"
    raw = visits(spark, ("u", moment, -1.0, "tv"), ("u", moment, -1.0, "tv"), (None, moment, 1.0, "tv"), ("u", "x", 1.0, "tv"))
    sinks.write_quality_report(quality_report(raw, members(spark)), str(tmp_path / "report"))
    line = open(next((tmp_path / "report").glob("part-*.json"))).read()
    assert '"quarantine":{"negative_duration":2,"null_user_id":1,"invalid_timestamp":1}' in line
    row = json.loads(line)
    assert (row["sessions_loaded"], row["sessions_valid"], row["fact_rows"]) == (4, 0, 0)


def test_one_policy_for_json_lines(spark, tmp_path):
    path = json_lines(
        tmp_path / "s.json", ("u", "2025-07-04T10:00:00", 1.5, "tv"), "{not json", "",
        '{"user_id": 7, "timestamp": "2025-07-04", "duration": "100", "platform": "tv", "more": [1]}',
        '{"user_id": "v", "timestamp": "2025-07-04", "duration": "long", "platform": "tv"}')
    raw = readers.read_sessions_json(spark, path)
    assert as_set(classify_sessions(raw), "user_id", "duration", "dq_reason") == {
        ("u", 1.5, None), (None, None, "malformed_record"), ("7", 100.0, None), ("v", None, None)}
    records = readers.sessions_from_records(spark.read.text(path))
    assert as_set(records) == as_set(raw)
    assert as_set(readers.sessions_from_records(sinks.session_records(records))) == as_set(raw)


def test_csv_fields_with_quotes_and_commas(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('user_id,country,created_at,updated_at\nu,"Korea ""S"", The",x,y\nv,,x,y\n')
    first = readers.read_accounts_csv(spark, str(path))
    assert as_set(first, "user_id", "country") == {("u", 'Korea "S", The'), ("v", None)}
    sinks.land_accounts_csv(first, str(tmp_path / "again"))
    assert as_set(readers.read_accounts_csv(spark, str(tmp_path / "again"))) == as_set(first)


def test_typed_parquet_sessions_are_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    rows = [("u", datetime(2025, 7, d, 12), 1.0, "tv") for d in (1, 4, 9)] + [("w", None, 1.0, "tv")]
    spark.createDataFrame(rows, "user_id string, timestamp timestamp_ntz, duration double, platform string").write.parquet(path)
    got = readers.read_sessions_parquet(spark, path, Window("2025-07-05", "2025-07-03", 0))
    assert as_set(got, "user_id", "timestamp") == {("u", "2025-07-04T12:00:00"), ("w", None)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(timestamp)" in plan


def test_quarantine_keeps_every_run(spark, tmp_path):
    path = str(tmp_path / "bad")
    rows = lambda *r: spark.createDataFrame(list(r), "user_id string, timestamp string, duration double, platform string, dq_reason string")
    sinks.write_quarantine(rows((None, "t", 1.0, "tv", "null_user_id"), ("u", "t", -1.0, "tv", "negative_duration")), path, "a")
    sinks.write_quarantine(rows(("v", None, 1.0, "tv", "null_timestamp")), path, "b")
    sinks.write_quarantine(rows(("u", "t", -2.0, "tv", "negative_duration")), path, "a")
    assert as_set(spark.read.parquet(path), "run", "dq_reason", "duration") == {("a", "negative_duration", -2.0), ("b", "null_timestamp", 1.0)}


def test_scratch_goes_after_a_load(spark, tmp_path):
    from pulsegrid.operators.tables import upsert_fact
    from pulsegrid.session import checkpoint_root, drop_scratch

    area = Path(checkpoint_root(spark).removeprefix("file:")) / "pulsegrid"
    before = set(area.glob("fact-*"))
    row = spark.createDataFrame([(date(2025, 7, 4), "u", "NO", "tv")], "activity_date date, user_id string, country string, platform string")
    for _ in range(2):
        upsert_fact(spark, row, str(tmp_path / "fact"))
    assert set(area.glob("fact-*")) == before
    with pytest.raises(ValueError):
        drop_scratch(spark, str(tmp_path))


def test_fact_ddl_registers_partitioned_table(spark, tmp_path):
    loc = str(tmp_path / "fact_tbl")
    fact = spark.createDataFrame([(date(2026, 9, 20), "u", "DE", "W")],
                                 "activity_date date, user_id string, country string, platform string")
    write_fact(fact, loc)
    create_fact_table(spark, "fact_ddl_test", loc)
    spark.sql("MSCK REPAIR TABLE fact_ddl_test")
    assert spark.table("fact_ddl_test").where(F.col("activity_date") == date(2026, 9, 20)).count() == 1
    spark.sql("DROP TABLE fact_ddl_test")
    with pytest.raises(ValueError):
        create_fact_table(spark, "bad name")


def test_jdbc_options_and_predicates():
    opts = readers.jdbc_account_options("jdbc:postgresql://db/x", "accounts", "etl", "pw")
    assert opts["fetchsize"] == "10000"
    assert opts["dbtable"].startswith("(SELECT user_id, country, created_at, updated_at FROM accounts)")
    preds = readers.jdbc_account_predicates(4)
    assert len(preds) == 5 and preds[-1] == "user_id IS NULL"
    with pytest.raises(ValueError):
        readers.jdbc_account_options("jdbc:x", "accounts; drop", None, None)


def test_run_hourly_ccu_job(spark, tmp_path):
    ccu_csv = str(tmp_path / "ccu")
    spark.createDataFrame([("2026-09-20T10:00:00", 10.0), ("2026-09-20T10:01:00", 30.0),
                           ("2026-09-20T11:00:00", 5.0)], "timestamp string, ccu double") \
        .write.option("header", True).csv(ccu_csv)
    cfg = JobConfig(window=Window("2026-09-20"), ccu_path=ccu_csv, output_dir=str(tmp_path / "out"))
    out = run_hourly_ccu(spark, cfg)
    assert [tuple(r) for r in out.hourly.orderBy("hour").collect()] == [
        (datetime(2026, 9, 20, 10, 0), 20.0), (datetime(2026, 9, 20, 11, 0), 5.0)]
    assert out.peak.first()["hour_label"] == "10:00"


def test_build_cubes_job(spark, tmp_path):
    sessions, accounts = fixtures.load_inputs(spark, SF_TINY)
    from pulsegrid.operators.activity import build_fact

    fact = build_fact(sessions, accounts)
    out = build_cubes(spark, fact, fixtures.ccu_from_events(fixtures.table(spark, SF_TINY, "events")),
                      str(tmp_path / "cubes"))
    meta = out.meta.first()
    assert meta["n_days"] == out.cube.where(F.col("level") == "day").count()
    assert meta["peak_ccu"]["hour_label"] is not None
    series = spark.read.json(str(tmp_path / "cubes" / "export" / "series"))
    assert series.where(F.size("series") != meta["n_days"]).count() == 0


def test_cli_run(spark, tmp_path, monkeypatch):
    from pulsegrid import cli

    sessions, accounts = fixtures.load_inputs(spark, SF_TINY)
    acc, sess = str(tmp_path / "acc"), str(tmp_path / "sess")
    sinks.land_accounts_csv(accounts, acc)
    sinks.land_sessions_jsonl(sessions, sess)
    for k, v in {"PULSEGRID_ACCOUNTS_PATH": acc, "PULSEGRID_SESSIONS_PATH": sess,
                 "PULSEGRID_FACT_PATH": str(tmp_path / "fact")}.items():
        monkeypatch.setenv(k, v)
    assert cli.main(["run", "--end-date", "2024-01-30", "--start-date", "2024-01-20", "--reprocess-window", "2"]) == 0
    dates = {r[0] for r in spark.read.parquet(str(tmp_path / "fact")).select("activity_date").distinct().collect()}
    assert min(dates) == date(2024, 1, 18) and max(dates) == date(2024, 1, 30)


def test_cube_refresh_replaces_only_touched_days(spark, tmp_path):
    from pulsegrid.plans.cube_build import refresh_cube

    schema = "activity_date date, user_id string, country string, platform string"
    v1 = spark.createDataFrame([(date(2026, 9, 1), "a", "DE", "W"), (date(2026, 9, 2), "a", "DE", "W")], schema)
    path = str(tmp_path / "cube")
    refresh_cube(spark, v1, path)
    v2 = v1.unionByName(spark.createDataFrame([(date(2026, 9, 2), "b", "US", "W"), (date(2026, 9, 1), "z", "FR", "W")],
                                              schema))
    cube = refresh_cube(spark, v2, path, (date(2026, 9, 2), date(2026, 9, 2)))
    day = {r["activity_date"]: r["dau"] for r in cube.where(F.col("level") == "day").collect()}
    # 09-02 recomputed (2 users); 09-01 untouched (the later row for it was outside the bounds)
    assert day == {date(2026, 9, 1): 1, date(2026, 9, 2): 2}


def test_cli_ccu_and_cubes(spark, tmp_path, monkeypatch):
    from pulsegrid import cli

    ccu_csv = str(tmp_path / "ccu")
    spark.createDataFrame([("2026-09-20T10:00:00", 4.0), ("2026-09-20T10:30:00", 6.0)], "timestamp string, ccu double") \
        .write.option("header", True).csv(ccu_csv)
    fact = spark.createDataFrame([(date(2026, 9, 20), "a", "DE", "W")],
                                 "activity_date date, user_id string, country string, platform string")
    write_fact(fact, str(tmp_path / "fact"))
    for k, v in {"PULSEGRID_CCU_PATH": ccu_csv, "PULSEGRID_OUTPUT_DIR": str(tmp_path / "out"),
                 "PULSEGRID_FACT_PATH": str(tmp_path / "fact"), "PULSEGRID_END_DATE": "2026-09-20"}.items():
        monkeypatch.setenv(k, v)
    assert cli.main(["ccu"]) == 0
    hourly = spark.read.schema("hour timestamp_ntz, avg_ccu double").option("header", True).csv(
        str(tmp_path / "out" / "hourly_ccu"))
    assert [r["avg_ccu"] for r in hourly.collect()] == [5.0]
    assert cli.main(["cubes", "--full", "--platforms", "W,Z"]) == 0
    export = tmp_path / "out" / "export"
    assert spark.read.json(str(export / "ccu")).count() == 1
    assert as_set(spark.read.json(str(export / "totals")), "by", "name", "users") == {("country", "DE", 1), ("platform", "W", 1)}
    assert as_set(spark.read.json(str(export / "lists")), "list", "name", "position") == {
        ("countries", "DE", 1), ("platforms", "W", 1), ("platforms", "Z", 2)}
    cube = spark.read.parquet(str(tmp_path / "out" / "cube"))
    assert cube.where(F.col("level") == "day").first()["dau"] == 1
