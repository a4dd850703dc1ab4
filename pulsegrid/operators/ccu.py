"""Hourly concurrent users."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.constants import CCU_SUM_DECIMAL, PEAK_CCU_DECIMALS
from pulsegrid.functions.predicates import ntz_literal
from pulsegrid.functions.timestamps import hour_bucket, hour_label


def finite(col: str) -> Column:
    return ~F.isnan(col) & (F.abs(F.col(col)) != F.lit(float("inf")))


def exact_mean(col: str) -> Column:
    """AVG as an exact decimal sum over the non-NULL count, returned as double.

    A floating-point sum depends on the order partitions are merged in; the decimal sum
    does not, so the result is identical on every run and every cluster layout. With a NaN or
    an infinity among the values the mean is what IEEE arithmetic makes of them, as AVG's is."""
    exact = F.sum(F.when(finite(col), F.col(col).cast(CCU_SUM_DECIMAL))).cast("double")
    odd = F.sum(F.when(~finite(col), F.col(col)))
    return F.coalesce(odd, F.try_divide(exact, F.count(col).cast("double")))


def hourly_ccu(ccu: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """A14 (+F14): ``(hour, avg_ccu)`` ordered by hour. One partial+final aggregate, a single
    shuffle keyed by hour. Optional time range is inclusive on both ends. Rows that the reader
    rejected are left out here and counted by :func:`ccu_rejects`."""
    df = ccu.where(F.col("reject").isNull()) if "reject" in ccu.columns else ccu
    if start is not None:
        df = df.where(F.col("ts") >= ntz_literal(start))
    if end is not None:
        df = df.where(F.col("ts") <= ntz_literal(end))
    return (
        df.where(F.col("ts").isNotNull())
        .groupBy(hour_bucket("ts").alias("hour"))
        .agg(exact_mean("ccu").alias("avg_ccu"))
        .orderBy("hour")
    )


def ccu_rejects(ccu: DataFrame) -> DataFrame:
    """``(reject, n)``: minutes left out of the means, by reason."""
    return ccu.where(F.col("reject").isNotNull()).groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


def ccu_peak(hourly: DataFrame) -> DataFrame:
    """The hour with the highest mean after rounding to one decimal (half-up); ties go
    to the earliest hour. Keeps the full hour next to the ``HH:mm`` label."""
    rounded = hourly.select("hour", F.round("avg_ccu", PEAK_CCU_DECIMALS).alias("peak_ccu"))
    return rounded.orderBy(F.desc("peak_ccu"), F.asc("hour")).limit(1).select(
        "hour", hour_label("hour").alias("hour_label"), "peak_ccu"
    )
