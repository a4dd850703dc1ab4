"""Build (or incrementally refresh) the DAU cube table from the fact table, export it
(K7), and compute the dashboard metadata (axis, totals, peak CCU). Slices and KPIs then read
the small cube table, never the fact."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import bitmaps as B
from pulsegrid.operators import cubes, metrics
from pulsegrid.operators.ccu import ccu_peak, hourly_ccu
from pulsegrid.operators.publish import changes
from pulsegrid.constants import DAYS_PER_YEAR, PEAK_CCU_DECIMALS, UNKNOWN_COUNTRY
from pulsegrid.functions.timestamps import hour_label
from pulsegrid.session import path_exists, prepare_session, scratch_path, stage
from pulsegrid.sources import sinks


@dataclass
class CubeOutputs:
    cube_path: str
    export_path: str
    cube: DataFrame
    meta: DataFrame


def refresh_cube(spark: SparkSession, fact: DataFrame, cube_path: str, date_bounds: tuple | None = None,
                 dates: list[date] | None = None) -> DataFrame:
    """Write the cube table partitioned by ``activity_date``. Every cube level is per day, so
    with ``date_bounds`` (inclusive) or a list of ``dates`` only those days are recomputed from
    the fact (a partition filter on the fact table) and only their cube partitions are replaced;
    a daily run refreshes its touched days instead of rebuilding all history."""
    if dates is not None:
        fact = fact.where(F.col("activity_date").isin([F.lit(d) for d in dates]))
    elif date_bounds is not None:
        lo, hi = date_bounds
        fact = fact.where(F.col("activity_date").between(F.lit(lo), F.lit(hi)))
    (
        cubes.build_cube(fact).hint("rebalance", "activity_date")
        .sortWithinPartitions("activity_date", "level", "country", "platform")
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if date_bounds is None and dates is None else "dynamic")
        .partitionBy("activity_date").parquet(cube_path)
    )
    return read_cube(spark, cube_path)


def read_cube(spark: SparkSession, cube_path: str) -> DataFrame:
    return spark.read.parquet(cube_path).select("activity_date", "level", "country", "platform", "dau")


def export_totals(fact: DataFrame) -> DataFrame:
    """``(by, name, users)``: distinct users over all days by known country and by platform."""
    parts = [metrics.dau_by(fact, by, exclude_unknown=by == "country").select(
        F.lit(by).alias("by"), F.col(by).alias("name"), F.col("dau").alias("users")) for by in ("country", "platform")]
    return parts[0].unionByName(parts[1])


def totals_of_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """:func:`export_totals` from the daily bitmaps, without the fact."""
    parts = [B.users_by(bitmaps, by, exclude_unknown=by == "country").select(
        F.lit(by).alias("by"), F.col(by).alias("name"), F.col("dau").alias("users")) for by in ("country", "platform")]
    return parts[0].unionByName(parts[1])


def meta_of_bitmaps(cube: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``cubes.axis_meta`` from the cube's axis and the daily bitmaps, without the fact."""
    n_days = F.count(F.lit(1))
    return cubes.date_axis(cube).agg(
        F.min("activity_date").alias("min_date"), F.max("activity_date").alias("max_date"), n_days.alias("n_days"),
        F.round(n_days / F.lit(DAYS_PER_YEAR), 1).alias("span_years"),
    ).select("*", B.distinct_users(bitmaps).scalar().alias("total_users"),
             B.distinct_users(bitmaps, country=UNKNOWN_COUNTRY).scalar().alias("unknown_users"))


@dataclass
class Followed:
    """What a run of :func:`follow_loads` did: the days it brought up to date, and the tables as they are now."""

    dates: list[date]
    cube: DataFrame
    bitmaps: DataFrame
    export_path: str


def follow_loads(spark: SparkSession, table: str, base: str, countries: list[str] | None = None,
                 platforms: list[str] | None = None) -> Followed:
    """Bring cube, bitmaps and export up to date with the loads that were published to the catalog table ``table`` since
    the last run on ``base``.

    Exactly the days that those loads changed are read from the fact and replaced, wherever they
    lie; the totals and the metadata come from the cube and the bitmaps. The last load is noted
    at the end, so a run that fails is done again from the same loads. At least one load must
    have been published."""
    prepare_session(spark)
    base = base.rstrip("/")
    done = ""
    if path_exists(spark, f"{base}/followed"):
        done = spark.read.schema("load string").parquet(f"{base}/followed/*").agg(F.max("load").alias("l")).first().l
    feed = changes(spark, table, done)
    last = feed.agg(F.max("load").alias("l")).first().l
    dates = sorted(r[0] for r in feed.select("activity_date").distinct().collect())  # one a day
    if dates:
        fact = spark.table(table)
        cube = refresh_cube(spark, fact, f"{base}/cube", dates=dates)
        bitmaps = B.refresh_bitmaps(spark, fact, base, dates)
        sinks.export_cube_json(cubes.cube_export_rows(cube), cubes.date_axis(cube), f"{base}/export",
                               totals_of_bitmaps(bitmaps), export_lists(cube, countries, platforms))
        meta_of_bitmaps(cube, bitmaps).coalesce(1).write.mode("overwrite").json(f"{base}/export/meta")
        spark.createDataFrame([(last,)], "load string").coalesce(1).write.mode("overwrite").parquet(f"{base}/followed/{last}")
    return Followed(dates, read_cube(spark, f"{base}/cube"), B.read_bitmaps(spark, base), f"{base}/export")


def export_lists(cube: DataFrame, countries: list[str] | None, platforms: list[str] | None) -> DataFrame:
    """``(list, name, position)``: the countries and platforms offered for slicing."""
    a = cubes.country_allow_list(cube, countries).select(F.lit("countries").alias("list"), F.col("country").alias("name"), "position")
    b = cubes.platform_list(cube, platforms).select(F.lit("platforms").alias("list"), F.col("platform").alias("name"), "position")
    return a.unionByName(b)


def build_cubes(spark: SparkSession, fact: DataFrame, ccu: DataFrame | None = None,
                out_dir: str | None = None, date_bounds: tuple | None = None,
                countries: list[str] | None = None, platforms: list[str] | None = None) -> CubeOutputs:
    prepare_session(spark)
    base = out_dir.rstrip("/") if out_dir else scratch_path(spark, "cubes")
    cube_path, export_path = f"{base}/cube", f"{base}/export"
    cube = refresh_cube(spark, fact, cube_path, date_bounds)
    sinks.export_cube_json(cubes.cube_export_rows(cube), cubes.date_axis(cube), export_path,
                           export_totals(fact), export_lists(cube, countries, platforms))
    meta = cubes.axis_meta(fact).withColumn(
        "generated", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    if ccu is not None:
        hourly = stage(spark, hourly_ccu(ccu), "hourly-ccu")
        # The hourly series as the dashboard shows it: HH:mm label and the mean to 1 decimal.
        hourly.orderBy("hour").select(
            "hour", hour_label("hour").alias("hour_label"),
            F.round("avg_ccu", PEAK_CCU_DECIMALS).alias("avg_ccu"),
        ).write.mode("overwrite").json(f"{export_path}/ccu")
        peak = ccu_peak(hourly)
        meta = meta.select(
            "*",
            peak.select(F.struct("hour", "hour_label", "peak_ccu")).scalar().alias("peak_ccu"),
        )
    meta.coalesce(1).write.mode("overwrite").json(f"{export_path}/meta")
    return CubeOutputs(cube_path, export_path, cube, meta)
