"""Entry points for users switching from the reference's Python API: the same two calls,
returning DataFrames instead of Python lists.

    out = transform(spark, "accounts.csv", "sessions.ndjson", fact_path="s3://.../fact")
    dau = query_dau(out.fact)
    dau.daily.show()
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.operators import metrics
from pulsegrid.operators.activity import build_fact
from pulsegrid.operators.tables import read_fact_if_exists, upsert_fact
from pulsegrid.plans.daily_activity import quality_report
from pulsegrid.session import prepare_session
from pulsegrid.sources.readers import read_accounts_csv, read_sessions_json


@dataclass
class TransformOutputs:
    fact: DataFrame  # (activity_date, user_id, country, platform)
    report: DataFrame  # one row: accounts/sessions loaded, valid, quarantined, q_<reason>, fact_rows, distinct_users


@dataclass
class DauOutputs:
    total: DataFrame  # distinct_users (not a sum of DAU)
    avg_daily: DataFrame  # avg_daily_dau, active_days
    daily: DataFrame  # (activity_date, dau) by day
    by_country: DataFrame  # (country, dau), dau desc
    by_platform: DataFrame  # (platform, dau), dau desc


def transform(spark: SparkSession, accounts_path: str, sessions_path: str, fact_path: str | None = None,
              mode: str = "replace") -> TransformOutputs:
    """Accounts CSV + sessions JSON lines -> quality rules -> fact rows. With ``fact_path`` the
    rows are upserted into that table (idempotent) and ``fact`` reads the table."""
    prepare_session(spark)
    accounts = read_accounts_csv(spark, accounts_path)
    sessions = read_sessions_json(spark, sessions_path)
    fact = build_fact(sessions, accounts)
    if fact_path is not None:
        upsert_fact(spark, fact, fact_path, mode=mode)
        fact = read_fact_if_exists(spark, fact_path)
    return TransformOutputs(fact, quality_report(sessions, accounts, fact))


def query_dau(fact: DataFrame) -> DauOutputs:
    """DAU = distinct users active on a calendar day; every figure is an exact distinct count."""
    return DauOutputs(
        total=metrics.dau_total(fact),
        avg_daily=metrics.dau_avg_daily(fact),
        daily=metrics.dau_daily(fact),
        by_country=metrics.dau_by(fact, "country"),
        by_platform=metrics.dau_by(fact, "platform"),
    )
