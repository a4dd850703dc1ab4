"""Data checks shipped with the fact table (the invariants the tests assert), as one-row
DataFrames a job can fail on. Each check is a distributed aggregate; nothing is collected
beyond the single result row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators import metrics
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS


def fact_checks(fact: DataFrame) -> DataFrame:
    """``fact_rows``, ``duplicate_keys`` (A15), ``null_fields``, and ``platform_bound_violations``:
    days where DAU is above the sum of platform DAUs or below the largest platform DAU
    (DAU is not additive, but it is bounded by both)."""
    base = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        (F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in FACT_KEYS])).alias("duplicate_keys"),
        F.count_if(F.col("activity_date").isNull() | F.col("user_id").isNull() | F.col("country").isNull()
                   | F.col("platform").isNull()).alias("null_fields"),
    )
    daily = metrics.dau_daily(fact).select("activity_date", F.col("dau").alias("total"))
    per_platform = (
        fact.groupBy("activity_date", "platform").agg(F.count_distinct("user_id").alias("dau"))
        .groupBy("activity_date").agg(F.max("dau").alias("mx"), F.sum("dau").alias("sm"))
    )
    violations = daily.join(per_platform, "activity_date").agg(
        F.count_if((F.col("total") > F.col("sm")) | (F.col("total") < F.col("mx"))).alias("v")
    ).scalar()
    return base.select("*", violations.alias("platform_bound_violations"))


def quality_balance(classified: DataFrame) -> DataFrame:
    """valid + quarantined = loaded, and each row has at most one reason by construction."""
    return classified.agg(
        F.count(F.lit(1)).alias("sessions_loaded"),
        F.count_if(F.col("dq_reason").isNull()).alias("sessions_valid"),
        F.count_if(F.col("dq_reason").isNotNull()).alias("sessions_quarantined"),
    ).withColumn("balanced", F.col("sessions_valid") + F.col("sessions_quarantined") == F.col("sessions_loaded"))


def enforce_fact(fact: DataFrame) -> None:
    """K8: raise ValueError when a key of the fact repeats or a field is NULL. One pass over
    the rows given, without the figures that :func:`fact_checks` adds."""
    keys = fact.groupBy(*FACT_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.greatest(*(F.col(c).isNull().cast("int") for c in FACT_COLUMNS))).alias("no_value"))
    found = keys.agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("no_value") > 0).alias("nulls")).first()
    if found["repeated"] or found["nulls"]:
        raise ValueError(f"fact table: {found['repeated']} keys repeat, {found['nulls']} keys have NULL fields")
