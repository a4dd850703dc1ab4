"""T4: exact DAU from a stream. Each micro-batch's distinct (day, user) pairs are added to a
day-partitioned set table, unless they are there, and DAU is recounted for the days that got new
pairs only. ``count(DISTINCT)`` is not available on streams, and an approximate count would not
be DAU. As for the fact, the table is the state and no session is too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import MAX_FILES_PER_TRIGGER
from pulsegrid.functions.timestamps import activity_date
from pulsegrid.operators.quality import valid_sessions
from pulsegrid.operators.tables import append_new_keys, replace_rows
from pulsegrid.session import drop_scratch, path_exists, scratch_path
from pulsegrid.streaming.common import classified_batch, run_sessions_stream

PAIR = ["activity_date", "user_id"]
DAU_SCHEMA = "activity_date date, dau long"


def run_dau_stream(
    spark: SparkSession,
    landing_path: str,
    table_path: str | None = None,
    checkpoint: str | None = None,
    quarantine_path: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    base = (table_path or scratch_path(spark, "stream-dau")).rstrip("/")
    pairs_path, dau_path = f"{base}/daily_users", f"{base}/dau"

    def load(batch: DataFrame, epoch_id: int) -> None:
        with classified_batch(spark, batch, epoch_id, quarantine_path or f"{base}/quarantine") as sessions:
            staged = scratch_path(spark, "dau-batch")
            valid_sessions(sessions).select(activity_date("ts").alias("activity_date"), "user_id").distinct() \
                .write.mode("overwrite").parquet(staged)
            pairs = spark.read.schema("activity_date date, user_id string").parquet(staged)
            if not pairs.isEmpty():
                append_new_keys(spark, pairs, pairs_path, PAIR, "activity_date")
                # All days of the batch, not only those with new pairs: if this micro-batch was
                # cut short after the pairs, its second run still brings the counts up to date.
                days = pairs.select("activity_date").distinct()
                recount = spark.read.parquet(pairs_path).join(days, "activity_date", "left_semi") \
                    .groupBy("activity_date").agg(F.count(F.lit(1)).alias("dau"))
                replace_rows(spark, recount, dau_path, keys=["activity_date"], partition_by="activity_date")
            drop_scratch(spark, staged)

    run_sessions_stream(spark, landing_path, load, "dau", checkpoint, max_files_per_trigger)
    if not path_exists(spark, dau_path):
        return spark.createDataFrame([], DAU_SCHEMA)
    return spark.read.parquet(dau_path).select("activity_date", "dau")
