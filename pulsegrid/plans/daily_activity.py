"""The daily-activity run, plus the report and summary DataFrames it produces.

Plan of a run:
  1. land the accounts and the run window of sessions (S8, F2) as raw files (K1, K2), counted in
     the same pass. The sources are read this once; all that follows works from the landed
     files, so its figures fit together whatever the sources do meanwhile
  2. classify (F5) and stage the classified sessions once as Parquet partitioned by
     ``dq_reason`` (counts observed in the same pass, rows written where they are scanned);
     valid rows are the NULL partition
  3. quarantine table <- the non-NULL partitions (F7), under the run's window
  4. fact batch <- grain dedupe of the valid partition, joined to one account per user
  5. merge the batch with the touched dates (K9 / K10), check grain and NOT NULL of what they
     are about to be (K8), and only then commit: to the folder, or through the catalog
  6. report, summary, fact CSV (K4, K5) from the observed counts and the fact table
Staging the classified rows cuts the lineage back to the raw JSON: both consumers read
Parquet, and a lost executor recomputes from the staged files, not from the raw scan. The
staged folder goes once both are committed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import JobConfig
from pulsegrid.constants import SUMMARY_TOP_N
from pulsegrid.operators import metrics
from pulsegrid.operators.activity import build_fact_from_valid
from pulsegrid.operators.checks import enforce_fact
from pulsegrid.operators.quality import (
    classify_sessions,
    quality_observations,
    quality_totals,
    valid_sessions,
)
from pulsegrid.operators.publish import create_published_fact, publish_load
from pulsegrid.operators.tables import export_fact_csv, read_fact_if_exists, upsert_fact
from pulsegrid.schemas import DQ_REASONS, FACT_COLUMNS, SESSION_FIELDS
from pulsegrid.session import drop_scratch, prepare_session, scratch_path, stage
from pulsegrid.sources import readers, sinks

TOTALS = ("sessions_loaded", "sessions_valid", "sessions_quarantined", *(f"q_{r}" for r in DQ_REASONS))


def _report(totals: DataFrame, accounts_loaded, fact: DataFrame) -> DataFrame:
    fact_stats = fact.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"))
    ).scalar()
    return totals.select(
        accounts_loaded.alias("accounts_loaded"), *TOTALS,
        fact_stats["rows"].alias("fact_rows"), fact_stats["users"].alias("distinct_users"),
    )


def quality_report(sessions: DataFrame, accounts: DataFrame, fact: DataFrame | None = None) -> DataFrame:
    """K5 content as one row: accounts_loaded, sessions loaded/valid/quarantined, one count
    per reason, fact_rows, distinct_users. Without ``fact`` the sessions are classified once
    and staged, and both the totals and the fact are derived from that."""
    classified = classify_sessions(sessions)
    if fact is None:
        classified = stage(sessions.sparkSession, classified, "classified")
        fact = build_fact_from_valid(valid_sessions(classified), accounts)
    return _report(quality_totals(classified), accounts.agg(F.count(F.lit(1))).scalar(), fact)


def run_summary(report: DataFrame, fact: DataFrame) -> DataFrame:
    """The printed run summary as a long table ``(section, key, value)``: counts, quarantine
    reasons, last 5 days of DAU, top 5 countries, DAU by platform. The first two sections are
    unfolded from the one row of ``report``, so what lies behind it is computed once."""
    avg = metrics.dau_avg_daily(fact).select("avg_daily_dau").scalar()

    def entry(section: str, key: str, value):
        return F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), value.cast("double").alias("value"))

    names = ("accounts_loaded", "sessions_loaded", "sessions_valid", "sessions_quarantined", "fact_rows", "distinct_users")
    entries = [entry("counts", c, F.col(c)) for c in names]
    reasons = [entry("quarantine", r, F.nullif(F.col(f"q_{r}"), F.lit(0))) for r in DQ_REASONS]
    head = report.select(F.explode(F.array(*entries, entry("counts", "avg_daily_dau", avg), *reasons)).alias("e")).select("e.*")
    head = head.where(F.col("value").isNotNull())
    last5 = metrics.last_n_days(fact, SUMMARY_TOP_N).select(
        F.lit("dau_last5").alias("section"), F.date_format("activity_date", "yyyy-MM-dd").alias("key"),
        F.col("dau").cast("double").alias("value"))
    top5 = metrics.top_n_countries(fact, SUMMARY_TOP_N).select(
        F.lit("top5_countries").alias("section"), F.col("country").alias("key"), F.col("dau").cast("double").alias("value"))
    platforms = metrics.dau_by(fact, "platform").select(
        F.lit("dau_by_platform").alias("section"), F.col("platform").alias("key"), F.col("dau").cast("double").alias("value"))
    return head.unionByName(last5).unionByName(top5).unionByName(platforms)


@dataclass
class RunOutputs:
    raw_path: str
    fact_path: str  # or the name of the catalog table
    quarantine_path: str
    csv_path: str
    report_path: str
    counts: dict
    fact: DataFrame
    summary: DataFrame


def run_daily_activity(spark: SparkSession, cfg: JobConfig) -> RunOutputs:
    """E1 end to end. Paths default to fresh folders under ``spark.checkpoint.dir``.

    Raises ValueError when the touched dates would break the fact's grain or have NULLs; the
    table then stays as it was. A window without valid sessions leaves it as it is, too."""
    prepare_session(spark)
    window = cfg.window
    base = (cfg.output_dir or scratch_path(spark, "run")).rstrip("/")
    raw_path = (cfg.raw_path or f"{base}/raw").rstrip("/")
    accounts_loaded = sinks.land_accounts_csv(readers.read_accounts(spark, cfg), f"{raw_path}/accounts")
    sinks.land_raw_sessions(readers.read_sessions(spark, cfg), f"{raw_path}/sessions")
    accounts = readers.read_accounts_csv(spark, f"{raw_path}/accounts")
    sessions = readers.read_sessions_json(spark, f"{raw_path}/sessions")

    staged_path = scratch_path(spark, "sessions-dq")
    obs = Observation("quality")
    classify_sessions(sessions).observe(obs, *quality_observations()).write.mode("overwrite").partitionBy("dq_reason").parquet(staged_path)
    counts = dict(obs.get)
    counts["sessions_quarantined"] = counts["sessions_loaded"] - counts["sessions_valid"]
    counts["accounts_loaded"] = accounts_loaded
    schema = "user_id string, timestamp string, duration double, platform string, ts timestamp_ntz, dq_reason string"
    staged = spark.read.schema(schema).parquet(staged_path)

    quarantine_path = cfg.quarantine_path or f"{base}/quarantine"
    sinks.write_quarantine(staged.where(F.col("dq_reason").isNotNull()).select(*SESSION_FIELDS, "dq_reason"),
                           quarantine_path, run=f"{window.extract_start}_{window.end_date}")

    batch = build_fact_from_valid(valid_sessions(staged), accounts)
    if cfg.fact_table:
        fact_path = cfg.fact_table
        if not spark.catalog.tableExists(fact_path):
            create_published_fact(spark, fact_path, cfg.fact_path or scratch_path(spark, "fact"))
        publish_load(spark, batch, fact_path, mode=cfg.upsert_mode)
        fact = spark.table(fact_path).select(*FACT_COLUMNS)
    else:
        fact_path = cfg.fact_path or scratch_path(spark, "fact")
        upsert_fact(spark, batch, fact_path, mode=cfg.upsert_mode, audit=enforce_fact)
        fact = read_fact_if_exists(spark, fact_path)
    drop_scratch(spark, staged_path)
    # The outputs cover the run's dates (a static partition filter), like a fresh table
    # holding only this window; they do not rescan the whole history every run.
    fact = fact.where(F.col("activity_date").between(F.lit(window.extract_start), F.lit(window.end_date)))
    totals = spark.createDataFrame([tuple(int(counts[c]) for c in TOTALS)], ", ".join(f"{c} long" for c in TOTALS))
    report_path, csv_path = f"{base}/quality_report", f"{base}/fact_csv"
    sinks.write_quality_report(_report(totals, F.lit(counts["accounts_loaded"]).cast("long"), fact), report_path)
    export_fact_csv(fact, csv_path)
    report = spark.read.json(report_path)
    return RunOutputs(raw_path, fact_path, quarantine_path, csv_path, report_path, counts, fact, run_summary(report, fact))
