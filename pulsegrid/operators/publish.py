"""K9 with a check before the change: a load is written beside the table, audited where it lies, and
only then made part of the table, through the catalog.

The fact table is a catalog table partitioned by ``activity_date`` (K8). A load writes the merged
rows of the dates it changes to a folder of its own. Grain and NULLs are checked on what was
written. Then every date's partition is pointed at its new folder (``ALTER TABLE ... SET
LOCATION``), one statement a date: a reader finds a date as it was or as it is, never half of
it, and a load that fails or breaks a rule leaves the table as it was. The folders that a load
replaces stay for the readers that still hold them, until :func:`drop_superseded`.

Every load also writes the dates it changed, with their rows before and after: the change feed
(T1) that the cube, the bitmaps and the export follow. A date whose rows a load would leave as
they are is not written and is no change.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import check_table_name
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.checks import enforce_fact
from pulsegrid.operators.tables import create_fact_table, layout_fact, merge_rows, without_keys
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS, FACT_SCHEMA
from pulsegrid.session import drop_scratch, path_exists, scratch_path

CHANGE_SCHEMA = "activity_date date, rows_before long, rows_after long"


class LoadConflict(RuntimeError):
    """Another load changed a partition between the reading and the publishing of this one."""


@dataclass(frozen=True)
class Published:
    """What a load did: its name, the dates it changed, and the folders no partition points at any more."""

    load: str
    dates: list[date]
    superseded: list[str]


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE FORMATTED {check_table_name(table)} {partition}").collect()
    # Of a partition, the table's own location comes last under the same name.
    return {r["col_name"]: r["data_type"] for r in reversed(rows)}


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Location"].rstrip("/")


def partition_locations(spark: SparkSession, table: str, dates: list[date]) -> dict[date, str]:
    """Where the partitions of ``dates`` are, for those that exist."""
    there = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {check_table_name(table)}").collect()}
    return {d: _described(spark, table, f"PARTITION ({_spec(d)})")["Location"] for d in dates if d.isoformat() in there}


def _spec(day: date) -> str:
    return f"activity_date='{day.isoformat()}'"


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def create_published_fact(spark: SparkSession, table: str, location: str, buckets: int | None = None) -> None:
    """K8: the table in the catalog, clustered by user into ``buckets`` if given. Its partitions come with its loads."""
    create_fact_table(spark, table, location, buckets)


def bucket_count(spark: SparkSession, table: str) -> int:
    """Buckets by user of a table, 0 where it is not clustered."""
    return int(_described(spark, table).get("Num Buckets", 0))


def write_clustered(spark: SparkSession, rows: DataFrame, folder: str, buckets: int, partition_by: list[str]) -> None:
    """Write ``rows`` to ``folder`` in ``buckets`` by user, one file a bucket and partition. Only tables are written in
    buckets, so the folder is one for the moment; what points there later has the same clustering."""
    passing = f"passing_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, "user_id").sortWithinPartitions(*partition_by, "user_id").write.mode("overwrite") \
        .bucketBy(buckets, "user_id").sortBy("user_id").option("path", folder)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(passing)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {passing}")


@contextmanager
def _clustering_counts(spark: SparkSession):
    """While it holds, rows clustered by user count as clustered for a join on user and more,
    so the stored side of a merge is read as it lies. One user has few rows."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    given = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, given)


def publish_accounts(spark: SparkSession, accounts: DataFrame, table: str, location: str, buckets: int) -> None:
    """K8: one account a user (D9) as a catalog table in ``buckets`` by user. It is replaced as a whole, by one statement."""
    folder = f"{location.rstrip('/')}/accounts-{uuid.uuid4().hex[:12]}"
    write_clustered(spark, latest_account_per_user(accounts).select("user_id", "country"), folder, buckets, [])
    if spark.catalog.tableExists(check_table_name(table)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {table}")
    else:
        spark.sql(f"CREATE TABLE {table} (user_id STRING, country STRING) USING parquet "
                  f"CLUSTERED BY (user_id) SORTED BY (user_id) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")


def _of_dates(rows: DataFrame, dates: list[date]) -> DataFrame:
    """A static partition filter: dates are literals, one a day."""
    return rows.where(F.col("activity_date").isin([F.lit(d) for d in dates]))


def publish_load(spark: SparkSession, new: DataFrame, table: str, mode: str = "replace",
                 audit: Callable[[DataFrame], None] = enforce_fact) -> Published:
    """Load a batch into the catalog table ``table`` by ``mode`` (see :func:`merge_rows`).

    Raises what ``audit`` raises on the rows it is given, those that the changed dates would
    have, or :class:`LoadConflict`; the table is then as it was. The batch's sources are
    scanned once. Its dates, one a day, are the only rows that pass through the driver."""
    location = table_location(spark, table)
    load = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    batch_path, folder = scratch_path(spark, "publish-batch"), f"{location}/loads/{load}"
    new.select(*FACT_COLUMNS).write.mode("overwrite").parquet(batch_path)
    batch = spark.read.schema(FACT_SCHEMA).parquet(batch_path)
    touched = sorted(r[0] for r in batch.select("activity_date").distinct().collect() if r[0] is not None)
    read_from = partition_locations(spark, table, touched)
    stored = _of_dates(spark.table(table), list(read_from)).select(*FACT_COLUMNS)

    # Rows that the load brings and the table does not have; in insert_only a stored key is enough.
    same = FACT_COLUMNS if mode == "replace" else FACT_KEYS
    news = without_keys(batch, stored, same).select("activity_date").distinct()
    dates = sorted((r[0] for r in news.collect()), key=str)
    if not dates:
        drop_scratch(spark, batch_path)
        return Published(load, [], [])
    days = [d for d in dates if d is not None]
    # A NULL date belongs to no partition: it goes along, for the audit to find.
    mine = batch.where(F.col("activity_date").isin([F.lit(d) for d in days]) | F.col("activity_date").isNull())
    merged, buckets = merge_rows(mine, _of_dates(stored, days), mode), bucket_count(spark, table)
    try:
        if buckets:
            with _clustering_counts(spark):
                write_clustered(spark, merged, folder, buckets, ["activity_date"])
        else:
            layout_fact(merged).write.mode("overwrite").partitionBy("activity_date").parquet(folder)
        written = spark.read.schema(FACT_SCHEMA).parquet(folder)
        audit(written)
        before = _of_dates(stored, days).groupBy("activity_date").agg(F.count(F.lit(1)).alias("rows_before"))
        after = written.groupBy("activity_date").agg(F.count(F.lit(1)).alias("rows_after"))
        changes = after.join(before, "activity_date", "left").select(
            "activity_date", F.coalesce("rows_before", F.lit(0)).cast("long").alias("rows_before"), "rows_after")
        changes.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_changes")
        if partition_locations(spark, table, days) != {d: p for d, p in read_from.items() if d in set(days)}:
            raise LoadConflict(f"{table}: another load has changed dates of load {load}")
    except BaseException:
        _delete(spark, folder)
        drop_scratch(spark, batch_path)
        raise
    finish_publish(spark, table, load, days)
    drop_scratch(spark, batch_path)
    return Published(load, days, [p for d, p in sorted(read_from.items()) if d in set(days)])


def finish_publish(spark: SparkSession, table: str, load: str, dates: list[date]) -> None:
    """Point the partitions of ``dates`` at the folders of an audited load, then put the load into the change feed.

    If the driver is lost on the way, the same call finishes the load: what points there already stays."""
    location = table_location(spark, table)
    there = partition_locations(spark, table, dates)
    for day in dates:
        path = f"{location}/loads/{load}/activity_date={day.isoformat()}"
        action = f"PARTITION ({_spec(day)}) SET LOCATION '{path}'" if day in there else f"ADD IF NOT EXISTS PARTITION ({_spec(day)}) LOCATION '{path}'"
        spark.sql(f"ALTER TABLE {check_table_name(table)} {action}")
    spark.read.schema(CHANGE_SCHEMA).parquet(f"{location}/loads/{load}/_changes") \
        .coalesce(1).write.mode("overwrite").parquet(f"{location}/changes/load={load}")
    spark.sql(f"REFRESH TABLE {check_table_name(table)}")


def drop_superseded(spark: SparkSession, published: Published) -> None:
    """Delete the folders that a load has replaced, when no reader can hold them any more."""
    for path in published.superseded:
        _delete(spark, path)


def changes(spark: SparkSession, table: str, after: str = "") -> DataFrame:
    """``(load, activity_date, rows_before, rows_after)`` of the loads after ``after``, in the order of ``load``."""
    path = f"{table_location(spark, table)}/changes"
    schema = f"{CHANGE_SCHEMA}, load string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).select("load", "activity_date", "rows_before", "rows_after")
    rows = spark.read.schema(schema).parquet(path)
    return rows.where(F.col("load") > after).select("load", "activity_date", "rows_before", "rows_after")
