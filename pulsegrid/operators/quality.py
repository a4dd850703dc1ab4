"""Data quality: classify, split, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.text import is_blank, is_empty
from pulsegrid.functions.timestamps import activity_date, parse_event_time, parse_strict_timestamp
from pulsegrid.constants import MALFORMED_REASON
from pulsegrid.schemas import DQ_REASONS, SESSION_FIELDS


def dq_reason(malformed: Column | None = None) -> Column:
    """First matching reason, or NULL for a valid row. Expects ``ts`` = parsed timestamp.

    A NULL duration is valid (``NULL < 0`` is not true), as is NaN. A line that was no JSON
    document has no fields to judge, so that is its reason.
    """
    rules = [
        (is_blank("user_id"), DQ_REASONS[0]),
        (F.col("timestamp").isNull(), DQ_REASONS[1]),
        (F.col("ts").isNull(), DQ_REASONS[2]),
        (is_blank("platform"), DQ_REASONS[3]),
        (F.col("duration") < 0, DQ_REASONS[4]),
    ]
    if malformed is not None:
        rules.insert(0, (malformed, MALFORMED_REASON))
    return F.coalesce(*(F.when(rule, F.lit(reason)) for rule, reason in rules))


def classify_sessions(raw: DataFrame) -> DataFrame:
    """raw sessions + ``ts`` (parsed, NTZ) + ``dq_reason``. A narrow projection: no shuffle."""
    malformed = F.col("malformed") if "malformed" in raw.columns else None
    return raw.withColumn("ts", parse_event_time("timestamp")).withColumn("dq_reason", dq_reason(malformed)).select(
        *SESSION_FIELDS, "ts", "dq_reason")


def valid_sessions(classified: DataFrame) -> DataFrame:
    """F6."""
    return classified.where(F.col("dq_reason").isNull())


def quarantined_sessions(classified: DataFrame) -> DataFrame:
    """the rows a production run routes to the quarantine table."""
    return classified.where(F.col("dq_reason").isNotNull()).select(*SESSION_FIELDS, "dq_reason")


def reason_rank(col: Column | str = "dq_reason") -> Column:
    """Canonical position of a reason (1-based), used as the tie-break after count."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(r) for r in DQ_REASONS]), c)


def quarantine_counts(classified: DataFrame) -> DataFrame:
    """A3: ``(dq_reason, n)`` for the reasons that occur, count desc then canonical order."""
    return (
        classified.where(F.col("dq_reason").isNotNull())
        .groupBy("dq_reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), reason_rank())
    )


def quality_totals(classified: DataFrame) -> DataFrame:
    """A1/A2 in one pass: loaded, valid, quarantined, plus one column per reason."""
    return classified.agg(
        F.count(F.lit(1)).alias("sessions_loaded"),
        F.count_if(F.col("dq_reason").isNull()).alias("sessions_valid"),
        F.count_if(F.col("dq_reason").isNotNull()).alias("sessions_quarantined"),
        *[F.count_if(F.col("dq_reason") == F.lit(r)).alias(f"q_{r}") for r in DQ_REASONS],
    )


def quality_observations() -> list[Column]:
    """The same totals as named metrics for ``DataFrame.observe`` during a write."""
    return [
        F.count(F.lit(1)).alias("sessions_loaded"),
        F.count_if(F.col("dq_reason").isNull()).alias("sessions_valid"),
        *[F.count_if(F.col("dq_reason") == F.lit(r)).alias(f"q_{r}") for r in DQ_REASONS],
    ]


def staging_view(raw: DataFrame) -> DataFrame:
    """The warehouse staging view's rule over typed sessions: three IS NOT NULL and
    ``duration >= 0``. Blank strings are kept and a NULL duration is dropped (unlike F5);
    an unparseable timestamp is NULL once typed."""
    typed = raw.select("user_id", parse_event_time("timestamp").alias("timestamp"), "duration", "platform")
    return typed.where(
        F.col("user_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("platform").isNotNull()
        & (F.col("duration") >= 0)
    ).select("user_id", "timestamp", "duration", "platform", activity_date("timestamp").alias("activity_date"))


def strict_valid_sessions(raw: DataFrame) -> DataFrame:
    """exact timestamp format, non-empty (untrimmed) user and platform, duration present
    and >= 0. Output typed, with the ``event_date`` partition column for landing."""
    ts = parse_strict_timestamp("timestamp")
    typed = raw.select("user_id", ts.alias("ts"), "duration", "platform")
    return typed.where(
        F.col("ts").isNotNull()
        & ~is_empty("user_id")
        & ~is_empty("platform")
        & F.col("duration").isNotNull()
        & (F.col("duration") >= 0)
    ).select(
        "user_id",
        F.col("ts").alias("timestamp"),
        "duration",
        "platform",
        activity_date("ts").alias("event_date"),
    )
