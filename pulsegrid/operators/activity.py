"""The fact table: valid sessions -> grain -> country -> one row per (date, user, platform)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.timestamps import activity_date
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.quality import classify_sessions, valid_sessions
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS, UNKNOWN_COUNTRY


def sessions_to_grain(valid: DataFrame) -> DataFrame:
    """A16 before the join: distinct (activity_date, user_id, platform).

    Partial aggregation runs map-side, so a hot user or day collapses to at most one row per
    key per task before the shuffle, and the join below sees bounded rows per user
    (days x platforms)."""
    return valid.select(activity_date("ts").alias("activity_date"), "user_id", "platform").dropDuplicates(
        FACT_KEYS
    )


def attach_country(grain: DataFrame, accounts_one: DataFrame) -> DataFrame:
    """Left outer equi-join on user_id; missing account or NULL country -> UNKNOWN.

    No broadcast hint: the accounts side grows with the user base (tens of millions of rows
    at target scale). The optimizer broadcasts it only when its size estimate is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans from runtime sizes; otherwise
    it is a sort-merge join on user_id with skew splitting."""
    joined = grain.join(accounts_one.select("user_id", "country"), "user_id", "left")
    return joined.select(
        "activity_date",
        "user_id",
        F.coalesce(F.col("country"), F.lit(UNKNOWN_COUNTRY)).alias("country"),
        "platform",
    )


def build_fact_from_valid(valid: DataFrame, accounts: DataFrame) -> DataFrame:
    return attach_country(sessions_to_grain(valid), latest_account_per_user(accounts)).select(*FACT_COLUMNS)


def build_fact(raw_sessions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Raw sessions + raw accounts -> fact rows (quality rules applied first, so NULL keys
    never reach the join)."""
    return build_fact_from_valid(valid_sessions(classify_sessions(raw_sessions)), accounts)


def grain_check(fact: DataFrame) -> DataFrame:
    """The fact is unique on its key. One pass: rows vs distinct keys."""
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct(*[F.col(k) for k in FACT_KEYS]).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("fact_rows") == F.col("distinct_keys"))
