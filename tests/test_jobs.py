"""End-to-end run (E1) over landed fixture files, and data invariants on the result."""

from datetime import date

import pytest
from conftest import SF_TINY, as_set, json_lines
from pyspark.sql import functions as F

from pulsegrid.config import JobConfig, Window
from pulsegrid.operators import metrics
from pulsegrid.operators.activity import build_fact, grain_check
from pulsegrid.plans.daily_activity import run_daily_activity
from pulsegrid.sources import fixtures, sinks


def _land(spark, tmp_path):
    sessions, accounts = fixtures.load_inputs(spark, SF_TINY)
    acc, sess = str(tmp_path / "accounts"), str(tmp_path / "sessions")
    n_acc = sinks.land_accounts_csv(accounts, acc)
    n_sess = sinks.land_sessions_jsonl(sessions, sess)
    return sessions, accounts, acc, sess, n_acc, n_sess


def test_run_daily_activity_end_to_end(spark, tmp_path):
    sessions, accounts, acc, sess, n_acc, n_sess = _land(spark, tmp_path)
    assert n_acc == accounts.count() and n_sess == sessions.count()
    window = Window(end_date=date(2024, 1, 30), start_date=date(2024, 1, 1), reprocess_days=0)
    cfg = JobConfig(window=window, accounts_path=acc, sessions_path=sess, fact_path=str(tmp_path / "fact"),
                    quarantine_path=str(tmp_path / "quarantine"))
    out = run_daily_activity(spark, cfg)
    c = out.counts
    assert c["sessions_loaded"] == n_sess  # the whole fixture lies in the window
    assert c["sessions_valid"] + c["sessions_quarantined"] == c["sessions_loaded"]
    assert sum(c[f"q_{r}"] for r in ("null_user_id", "null_timestamp", "invalid_timestamp", "null_platform",
                                     "negative_duration")) == c["sessions_quarantined"]
    expected = {tuple(r) for r in build_fact(sessions, accounts).collect()}
    assert {tuple(r) for r in out.fact.collect()} == expected
    assert spark.read.parquet(out.quarantine_path).count() == c["sessions_quarantined"]
    summary = {(r["section"], r["key"]): r["value"] for r in out.summary.collect()}
    assert summary[("counts", "fact_rows")] == len(expected)
    written = spark.read.option("header", True).csv(out.csv_path)
    assert written.count() == len(expected)
    report = spark.read.json(out.report_path).first()
    assert (report["fact_rows"], report["sessions_loaded"]) == (len(expected), n_sess)
    # re-run: idempotent, also in the quarantine
    out2 = run_daily_activity(spark, cfg)
    assert out2.fact.count() == len(expected)
    assert spark.read.parquet(out2.quarantine_path).count() == c["sessions_quarantined"]


def test_window_without_valid_sessions(spark, tmp_path):
    raw = json_lines(tmp_path / "raw.json", (None, "2025-07-04T10:00:00", 1, "tv"))
    accounts = tmp_path / "accounts.csv"
    accounts.write_text("user_id,country,created_at,updated_at\n")
    cfg = JobConfig(window=Window("2025-07-04"), accounts_path=str(accounts), sessions_path=raw,
                    fact_path=str(tmp_path / "fact"), output_dir=str(tmp_path / "out"))
    out = run_daily_activity(spark, cfg)
    assert out.fact.count() == 0 and out.counts["q_null_user_id"] == 1
    assert ("counts", "fact_rows", 0.0) in as_set(out.summary)


RAW = [("ann", "2025-07-04T10:00:00", 1, "tv"), ("bob", "2025-07-04T11:00:00", 1, "tv"), '{"user_id": "cut', (None, "2025-07-04T10:00:00", 1, "tv")]


def _cfg(tmp_path, **more):
    (tmp_path / "accounts.csv").write_text('user_id,country,created_at,updated_at\nann,"N,O",,\n')
    raw = json_lines(tmp_path / "raw.json", *RAW, '{"user_id": "eve", "timestamp": "2025-07-05T10:00:00", "duration": "7", "platform": "tv", "more": 1}')
    return JobConfig(window=Window("2025-07-05"), accounts_path=str(tmp_path / "accounts.csv"), sessions_path=raw,
                     output_dir=str(tmp_path / "out"), **more)


FACT = {(date(2025, 7, 4), "ann", "N,O", "tv"), (date(2025, 7, 4), "bob", "UNKNOWN", "tv"), (date(2025, 7, 5), "eve", "UNKNOWN", "tv")}


def test_the_run_lands_what_it_works_from(spark, tmp_path):
    out = run_daily_activity(spark, _cfg(tmp_path, fact_path=str(tmp_path / "fact")))
    assert as_set(out.fact) == FACT and out.counts["q_malformed_record"] == 1 and out.counts["accounts_loaded"] == 1
    lines = {r.value for r in spark.read.text(f"{out.raw_path}/sessions").collect()}
    assert '{"user_id": "cut' in lines and len(lines) == 5
    # The landed files are sources themselves: a run on them gives the same.
    cfg = JobConfig(window=Window("2025-07-05"), accounts_path=f"{out.raw_path}/accounts", sessions_path=f"{out.raw_path}/sessions",
                    fact_path=str(tmp_path / "fact2"), output_dir=str(tmp_path / "out2"))
    again = run_daily_activity(spark, cfg)
    assert as_set(again.fact) == FACT and again.counts == out.counts


def test_the_run_through_the_catalog(spark, tmp_path):
    cfg = _cfg(tmp_path, fact_path=str(tmp_path / "table"), fact_table="fact_of_run")
    try:
        out = run_daily_activity(spark, cfg)
        assert out.fact_path == "fact_of_run" and as_set(out.fact) == FACT
        assert run_daily_activity(spark, cfg).fact.count() == 3
        assert spark.table("fact_of_run").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS fact_of_run")


@pytest.mark.parametrize("through_catalog", [False, True])
def test_a_violating_batch_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch, through_catalog):
    from pulsegrid.plans import daily_activity as job

    cfg = _cfg(tmp_path, fact_path=str(tmp_path / "fact"), fact_table="fact_of_bad_run" if through_catalog else None)
    try:
        run_daily_activity(spark, cfg)
        build = job.build_fact_from_valid
        monkeypatch.setattr(job, "build_fact_from_valid", lambda *a: build(*a).unionByName(
            spark.createDataFrame([(date(2025, 7, 4), "ann", "SE", "tv")], "activity_date date, user_id string, country string, platform string")))
        with pytest.raises(ValueError, match="keys repeat"):
            run_daily_activity(spark, cfg)
        table = spark.table("fact_of_bad_run") if through_catalog else spark.read.parquet(str(tmp_path / "fact"))
        assert as_set(table, "activity_date", "user_id", "country", "platform") == FACT
    finally:
        spark.sql("DROP TABLE IF EXISTS fact_of_bad_run")


def test_broken_fact_table_stops_the_run(spark):
    from pulsegrid.operators.checks import enforce_fact

    rows = [(date(2025, 7, 4), "a", "NO", "tv"), (date(2025, 7, 4), "b", "NO", "tv")]
    schema = "activity_date date, user_id string, country string, platform string"
    enforce_fact(spark.createDataFrame(rows, schema))
    for bad in (rows[0], (date(2025, 7, 5), "c", None, "tv")):
        with pytest.raises(ValueError):
            enforce_fact(spark.createDataFrame([*rows, bad], schema))


def test_invariants_on_fixture(spark):
    sessions, accounts = fixtures.load_inputs(spark, SF_TINY)
    fact = build_fact(sessions, accounts)
    g = grain_check(fact).first()
    assert g["is_unique"]
    daily = metrics.dau_daily(fact).withColumnRenamed("dau", "total")
    per_platform = metrics.dau_by_day_and(fact, "platform").groupBy("activity_date").agg(
        F.max("dau").alias("mx"), F.sum("dau").alias("sm"))
    bad = daily.join(per_platform, "activity_date").where(
        (F.col("mx") > F.col("total")) | (F.col("total") > F.col("sm")))
    assert bad.count() == 0
    assert fact.where(F.col("country").isNull() | F.col("user_id").isNull() | F.col("platform").isNull()).count() == 0


def test_fact_checks_detect_violations(spark):
    from pulsegrid.operators.checks import fact_checks

    good = spark.createDataFrame([(date(2026, 9, 20), "a", "DE", "W"), (date(2026, 9, 20), "a", "DE", "A")],
                                 "activity_date date, user_id string, country string, platform string")
    r = fact_checks(good).first()
    assert (r["fact_rows"], r["duplicate_keys"], r["null_fields"], r["platform_bound_violations"]) == (2, 0, 0, 0)
    bad = good.unionByName(spark.createDataFrame([(date(2026, 9, 20), "a", None, "W")], good.schema))
    r = fact_checks(bad).first()
    assert (r["duplicate_keys"], r["null_fields"]) == (1, 1)
