"""Exact, non-additive DAU metrics on the fact table.

Every distinct count is ``count(DISTINCT user_id)`` per grouping; nothing is ever summed
across platforms, countries or days. Spark plans each as a two-phase distinct aggregate
(dedupe on (group, user) map-side, shuffle on (group, user), then count per group), so a hot
day or country is spread by user_id and never lands in one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import date_range, equals_if_given
from pulsegrid.schemas import UNKNOWN_COUNTRY


def filter_fact(
    fact: DataFrame,
    start: date | None = None,
    end: date | None = None,
    country: str | None = None,
    platform: str | None = None,
) -> DataFrame:
    """F10 + F11: inclusive date range (a partition filter on the stored table) and optional
    equality filters; ``None``/``"All"`` means no filter."""
    return fact.where(
        date_range("activity_date", start, end)
        & equals_if_given("country", country)
        & equals_if_given("platform", platform)
    )


def _dau():
    return F.count_distinct("user_id").alias("dau")


def dau_daily(fact: DataFrame, start=None, end=None, country=None, platform=None) -> DataFrame:
    """A5 (+F10/F11): ``(activity_date, dau)`` ordered by day."""
    return (
        filter_fact(fact, start, end, country, platform)
        .groupBy("activity_date")
        .agg(_dau())
        .orderBy("activity_date")
    )


def dau_by(fact: DataFrame, key: str, start=None, end=None, exclude_unknown: bool = False) -> DataFrame:
    """A6/A7 (+A13): distinct users per ``key`` over a range, dau desc then key."""
    df = filter_fact(fact, start, end)
    if exclude_unknown:
        df = df.where(F.col("country") != F.lit(UNKNOWN_COUNTRY))
    return df.groupBy(key).agg(_dau()).orderBy(F.desc("dau"), F.col(key))


def dau_total(fact: DataFrame, start=None, end=None, country=None, platform=None) -> DataFrame:
    """A4: distinct users over the whole (filtered) table; explicitly not a sum of DAU."""
    return filter_fact(fact, start, end, country, platform).agg(F.count_distinct("user_id").alias("distinct_users"))


def dau_avg_daily(fact: DataFrame, start=None, end=None) -> DataFrame:
    """Mean of daily DAU over the days that have activity; 0.0 when empty."""
    daily = filter_fact(fact, start, end).groupBy("activity_date").agg(_dau())
    return daily.agg(
        F.coalesce(F.avg("dau"), F.lit(0.0)).alias("avg_daily_dau"),
        F.count(F.lit(1)).alias("active_days"),
    )


def dau_by_day_and(fact: DataFrame, *keys: str) -> DataFrame:
    """DAU per day x country / platform / country x platform."""
    cols = ["activity_date", *keys]
    return fact.groupBy(*cols).agg(_dau()).orderBy(*cols)


def unknown_users(fact: DataFrame) -> DataFrame:
    """Distinct users whose country is UNKNOWN (F12 selection)."""
    return fact.where(F.col("country") == F.lit(UNKNOWN_COUNTRY)).agg(
        F.count_distinct("user_id").alias("unknown_users")
    )


def last_n_days(fact: DataFrame, n: int = 5) -> DataFrame:
    """O3: the last ``n`` days of the DAU series (a top-k: the limit is the feature)."""
    return dau_daily(fact).orderBy(F.desc("activity_date")).limit(n)


def top_n_countries(fact: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` countries with most distinct users (ties by name)."""
    return dau_by(fact, "country").orderBy(F.desc("dau"), F.col("country")).limit(n)
