"""Hourly CCU job. Minute CSV export -> hourly mean -> CSV, plus the peak hour."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import JobConfig
from pulsegrid.constants import CCU_REJECTS, CSV_DIALECT
from pulsegrid.operators.ccu import ccu_peak, hourly_ccu
from pulsegrid.session import prepare_session, scratch_path
from pulsegrid.sources import readers, sinks


@dataclass
class CcuOutputs:
    hourly_path: str
    hourly: DataFrame
    peak: DataFrame
    rejects: dict


def run_hourly_ccu(spark: SparkSession, cfg: JobConfig, start: datetime | None = None,
                   end: datetime | None = None) -> CcuOutputs:
    prepare_session(spark)
    # What the reader rejects is counted while the means are computed: the export is parsed once.
    obs = Observation("ccu_rejects")
    minutes = readers.read_ccu_csv(spark, cfg.ccu_path).observe(
        obs, *(F.count_if(F.col("reject") == r).alias(r) for r in CCU_REJECTS))
    hourly = hourly_ccu(minutes, start, end)
    out = f"{cfg.output_dir.rstrip('/')}/hourly_ccu" if cfg.output_dir else scratch_path(spark, "hourly-ccu")
    sinks.write_hourly_ccu_csv(hourly, out)
    written = spark.read.schema("hour timestamp_ntz, avg_ccu double").options(**CSV_DIALECT).csv(out)
    rejects = {reason: n for reason, n in obs.get.items() if n}
    return CcuOutputs(out, written, ccu_peak(written), rejects)
