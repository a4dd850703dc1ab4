"""Exact distinct users over any range of days without reading the fact again.

Every user has an ordinal for good. Each day keeps, for all users, for every country, every
platform and every pair of them, the bitmaps of the ordinals that were active, 32,768 of them in
a bitmap. Distinct users of a range are the bits of the bitmaps OR-ed over its days. New users
get the next ordinals by country and id, so the bitmaps of a country are dense and few. A
changed day replaces its own bitmaps and nothing else.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import UNKNOWN_COUNTRY
from pulsegrid.functions.predicates import date_range
from pulsegrid.operators.numbering import number_rows
from pulsegrid.session import path_exists, stage

ALL, BY_COUNTRY, BY_PLATFORM, BY_BOTH = LEVELS = ("all", "country", "platform", "country_platform")
USER_SCHEMA = "user_id string, ordinal long"
BITMAP_SCHEMA = "level string, country string, platform string, bucket long, bitmap binary, activity_date date"


def read_users(spark: SparkSession, base: str) -> DataFrame:
    """``(user_id, ordinal)``; ordinals start at 1."""
    path = f"{base.rstrip('/')}/users"
    if not path_exists(spark, path):
        return spark.createDataFrame([], USER_SCHEMA)
    return spark.read.schema(USER_SCHEMA).parquet(f"{path}/*")


def add_users(spark: SparkSession, base: str, fact: DataFrame) -> None:
    """Give ordinals to the users of ``fact`` that have none. Run again after a failure it rewrites its own slice."""
    known = read_users(spark, base)
    one = fact.groupBy("user_id").agg(F.min("country").alias("country"))
    fresh = stage(spark, one.join(known, "user_id", "left_anti"), "new-users")
    if not fresh.isEmpty():
        start = (known.agg(F.max("ordinal").alias("m")).first().m or 0) + 1
        number_rows(fresh, ["country", "user_id"], start, "ordinal").select("user_id", "ordinal") \
            .write.mode("overwrite").parquet(f"{base.rstrip('/')}/users/from={start}")


def user_slices() -> Column:
    """The slices that a row of the fact counts in: (level, country, platform), NULL where a level has no such column."""
    no = F.lit(None).cast("string")
    slices = [(ALL, no, no), (BY_COUNTRY, F.col("country"), no), (BY_PLATFORM, no, F.col("platform")), (BY_BOTH, F.col("country"), F.col("platform"))]
    return F.array(*(F.struct(F.lit(level).alias("level"), c.alias("country"), p.alias("platform")) for level, c, p in slices))


def daily_bitmaps(fact: DataFrame, users: DataFrame) -> DataFrame:
    """``(activity_date, level, country, platform, bucket, bitmap)`` for the :func:`user_slices` of the fact."""
    rows = fact.join(users, "user_id").select("activity_date", "ordinal", F.explode(user_slices()).alias("s"))
    return rows.groupBy("activity_date", "s.level", "s.country", "s.platform", F.bitmap_bucket_number("ordinal").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ordinal")).alias("bitmap"))


def refresh_bitmaps(spark: SparkSession, fact: DataFrame, base: str, dates: list[date] | None = None) -> DataFrame:
    """Bring the bitmaps of ``dates`` (all days if not given) up to date with ``fact`` and return the table."""
    base = base.rstrip("/")
    if dates is not None:
        fact = fact.where(F.col("activity_date").isin([F.lit(d) for d in dates]))
    add_users(spark, base, fact)
    daily_bitmaps(fact, read_users(spark, base)).hint("rebalance", "activity_date") \
        .sortWithinPartitions("activity_date", "level", "country", "platform", "bucket") \
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if dates is None else "dynamic") \
        .partitionBy("activity_date").parquet(f"{base}/bitmaps")
    return read_bitmaps(spark, base)


def read_bitmaps(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(BITMAP_SCHEMA).parquet(f"{base.rstrip('/')}/bitmaps")


def _users(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The bits of the bitmaps OR-ed, first in every task: one bitmap of 4 KB a slice and bucket is shuffled."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("users"))


def _in(bitmaps: DataFrame, level: str, start: date | None, end: date | None) -> DataFrame:
    return bitmaps.where((F.col("level") == level) & date_range("activity_date", start, end))


def distinct_users(bitmaps: DataFrame, start: date | None = None, end: date | None = None,
                   country: str | None = None, platform: str | None = None) -> DataFrame:
    """A4: ``distinct_users`` of a range, in one row; of one country, one platform or both where given."""
    level = {(False, False): ALL, (True, False): BY_COUNTRY, (False, True): BY_PLATFORM, (True, True): BY_BOTH}[country is not None, platform is not None]
    rows = _in(bitmaps, level, start, end)
    for name, value in (("country", country), ("platform", platform)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return _users(rows).select(F.col("users").alias("distinct_users"))


def users_by(bitmaps: DataFrame, by: str, start: date | None = None, end: date | None = None, exclude_unknown: bool = False) -> DataFrame:
    """``(by, dau)``, distinct users of a range by country or platform."""
    rows = _in(bitmaps, by, start, end)
    if exclude_unknown:
        rows = rows.where(F.col("country") != UNKNOWN_COUNTRY)
    return _users(rows, by).select(by, F.col("users").alias("dau")).orderBy(F.desc("dau"), by)
