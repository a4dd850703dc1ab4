"""Hourly CCU as a stream. Each micro-batch writes the exact (sum, count) of every hour it has
minutes of, in a slice of its own; the mean of an hour is the total of its slices. So the order
and size of the micro-batches do not matter, no minute is too late, and a micro-batch that is
run again rewrites its own slice. Minutes that cannot be used are kept by micro-batch, with the
reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import CCU_SUM_DECIMAL, CSV_DIALECT, MAX_FILES_PER_TRIGGER
from pulsegrid.functions.timestamps import activity_date, hour_bucket
from pulsegrid.operators.ccu import finite
from pulsegrid.schemas import CCU_CSV_SCHEMA
from pulsegrid.session import path_exists, scratch_path
from pulsegrid.sources.readers import ccu_columns
from pulsegrid.streaming.common import checkpoint_location, run_available_now

HOURLY_SCHEMA = "hour timestamp_ntz, avg_ccu double"


def hourly_parts(minutes: DataFrame) -> DataFrame:
    """``(hour_date, hour, ccu_sum, ccu_odd, ccu_n)`` of usable minutes: the exact sum of the
    finite values, the sum of the others, and how many there are of both."""
    return minutes.where(F.col("reject").isNull()).groupBy(hour_bucket("ts").alias("hour")).agg(
        F.sum(F.when(finite("ccu"), F.col("ccu").cast(CCU_SUM_DECIMAL))).alias("ccu_sum"),
        F.sum(F.when(~finite("ccu"), F.col("ccu"))).alias("ccu_odd"),
        F.count("ccu").alias("ccu_n"),
    ).select(activity_date("hour").alias("hour_date"), "hour", "ccu_sum", "ccu_odd", "ccu_n")


def hourly_means(parts: DataFrame) -> DataFrame:
    return parts.groupBy("hour").agg(
        F.coalesce(F.sum("ccu_odd"), F.try_divide(F.sum("ccu_sum").cast("double"), F.sum("ccu_n").cast("double"))).alias("avg_ccu"))


def run_ccu_stream(
    spark: SparkSession,
    landing_path: str,
    table_path: str | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    base = (table_path or scratch_path(spark, "stream-ccu")).rstrip("/")
    raw = spark.readStream.schema(CCU_CSV_SCHEMA).options(**CSV_DIALECT).option("maxFilesPerTrigger", max_files_per_trigger).csv(landing_path)

    def load(batch: DataFrame, epoch_id: int) -> None:
        # One scan for both outputs is not worth a staged copy: the rejects are a filter.
        hourly_parts(batch).hint("rebalance").write.mode("overwrite").parquet(f"{base}/parts/epoch={epoch_id}")
        batch.where(F.col("reject").isNotNull()).write.mode("overwrite").parquet(f"{base}/rejected/epoch={epoch_id}")

    run_available_now(ccu_columns(raw).writeStream.foreachBatch(load)
                      .option("checkpointLocation", checkpoint_location(spark, "ccu", checkpoint)))
    if not path_exists(spark, f"{base}/parts"):
        return spark.createDataFrame([], HOURLY_SCHEMA)
    return hourly_means(spark.read.parquet(f"{base}/parts"))
