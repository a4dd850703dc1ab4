"""T3 in event time: tumbling hours with a watermark. An hour is written once, when the watermark has passed its end, and
never changes. Minutes that come later go to a table of corrections, which the reader adds to the hour they belong to.
Hours that are still open are computed from the minutes kept for them.

Every micro-batch reads its files once (see ``routing``). Tables hold exact sums and counts, so a mean does not depend on
the order in which minutes came."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import CCU_LATENESS_HOURS, CCU_SUM_DECIMAL, CSV_DIALECT, MAX_FILES_PER_TRIGGER
from pulsegrid.functions.predicates import ntz_literal
from pulsegrid.functions.timestamps import activity_date
from pulsegrid.operators.ccu import finite
from pulsegrid.schemas import CCU_CSV_SCHEMA
from pulsegrid.session import path_exists, stage
from pulsegrid.sources.readers import ccu_columns
from pulsegrid.streaming import routing as R
from pulsegrid.streaming.ccu_stream import hourly_means, hourly_parts

MINUTE_SCHEMA = "ts timestamp_ntz, ccu double, reject string"
PARTS = ["hour", "ccu_sum", "ccu_odd", "ccu_n"]
PART_SCHEMA = f"hour timestamp_ntz, ccu_sum {CCU_SUM_DECIMAL}, ccu_odd double, ccu_n long"
HOUR = timedelta(hours=1)


def _closing_hours(minutes: DataFrame) -> DataFrame:
    """The tumbling hours of a watermarked stream: sums that are emitted when an hour is closed."""
    return minutes.groupBy(F.window("event_time", "1 hour")).agg(
        F.sum(F.when(finite("ccu"), F.col("ccu").cast(CCU_SUM_DECIMAL))).alias("ccu_sum"),
        F.sum(F.when(~finite("ccu"), F.col("ccu"))).alias("ccu_odd"),
        F.count("ccu").alias("ccu_n"),
    ).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "ccu_sum", "ccu_odd", "ccu_n")


def run_ccu_hours_stream(
    spark: SparkSession,
    landing_path: str,
    base: str,
    lateness: timedelta = timedelta(hours=CCU_LATENESS_HOURS),
    horizon: datetime | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Process what has landed since the last run on ``base`` and return ``(hour, avg_ccu)``."""
    base = base.rstrip("/")
    raw = spark.readStream.schema(CCU_CSV_SCHEMA).options(**CSV_DIALECT).option("maxFilesPerTrigger", max_files_per_trigger).csv(landing_path)
    R.run_router(spark, ccu_columns(raw), base, lateness, horizon)

    def load(batch: DataFrame, epoch: int) -> None:
        R.write_slices(batch.withColumn("hour_date", activity_date("hour")), f"{base}/hours", "hour_date", f"batch-{epoch}")

    if path_exists(spark, f"{base}/routed"):
        R.run_stateful(spark, base, MINUTE_SCHEMA, lateness, _closing_hours, load)
        first, last = R.side_epochs(spark, base)
        if first <= last:
            late = R.routed(spark, base, MINUTE_SCHEMA, R.LATE, R.AHEAD).where(F.col("epoch").between(first, last))
            corrections = stage(spark, hourly_parts(late), "ccu-corrections")
            if not corrections.isEmpty():
                R.write_slices(corrections, f"{base}/corrections", "hour_date", f"side-{first}-{last}")
            R.side_merged(spark, base, last)
        _drop_closed_minutes(spark, base)
    return hourly_means(hour_parts(spark, base)).select("hour", "avg_ccu")


def _table(spark: SparkSession, path: str) -> DataFrame:
    """A table of parts; empty before its first slice."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PART_SCHEMA)
    return spark.read.schema(PART_SCHEMA).parquet(path).select(*PARTS)


def closed_until(spark: SparkSession, base: str) -> datetime | None:
    """The end of the last closed hour. All hours before it are closed: the watermark passes them in order."""
    last = _table(spark, f"{base}/hours").agg(F.max("hour").alias("h")).first().h
    return last + HOUR if last else None


def hour_parts(spark: SparkSession, base: str) -> DataFrame:
    """``(hour, ccu_sum, ccu_odd, ccu_n, state)``: parts of ``closed`` hours, of their ``correction``, and of ``open`` hours."""
    base = base.rstrip("/")
    until = closed_until(spark, base)
    open_minutes = R.routed(spark, base, MINUTE_SCHEMA, R.ON_TIME)
    if until is not None:
        open_minutes = open_minutes.where(F.col("ts") >= ntz_literal(until))
    parts = {"closed": _table(spark, f"{base}/hours"), "correction": _table(spark, f"{base}/corrections"),
             "open": hourly_parts(open_minutes).select(*PARTS)}
    closed, correction, still_open = (rows.withColumn("state", F.lit(state)) for state, rows in parts.items())
    return closed.unionByName(correction).unionByName(still_open)


def hour_states(spark: SparkSession, base: str) -> DataFrame:
    """``(hour, avg_ccu, minutes, late_minutes, is_open)``: minutes with a value, those of them that came late, and whether the hour may still change."""
    parts = hour_parts(spark, base)
    counts = parts.groupBy("hour").agg(
        F.sum("ccu_n").alias("minutes"), F.sum(F.when(F.col("state") == "correction", F.col("ccu_n")).otherwise(0)).alias("late_minutes"),
        F.bool_or(F.col("state") == "open").alias("is_open"))
    return hourly_means(parts).join(counts, "hour").select("hour", "avg_ccu", "minutes", "late_minutes", "is_open")


def rejected_minutes(spark: SparkSession, base: str) -> DataFrame:
    return R.routed(spark, base.rstrip("/"), MINUTE_SCHEMA, R.REJECTED).select("reject")


def _drop_closed_minutes(spark: SparkSession, base: str) -> None:
    """Delete the minutes of micro-batches whose hours are all closed, so that what is kept is what is open."""
    until = closed_until(spark, base)
    if until is not None:
        # Marks are one short row a micro-batch; those gone already are cheap to name again.
        done = R.read_marks(spark, base).where((F.col("latest") < ntz_literal(until)) & (F.col(R.ON_TIME) > 0))
        R.drop_on_time(spark, base, [r.epoch for r in done.select("epoch").toLocalIterator()])
