"""Fact table storage: layout (K3, K8), idempotent upsert (K9) and insert-only merge.

The fact lives as Parquet partitioned by ``activity_date`` and clustered (sorted) by
``country, platform, user_id`` inside each partition, so date filters prune directories and
country/platform filters skip row groups by min/max statistics.

Writes only ever replace the dates they touch (dynamic partition overwrite). The merged
rows are first staged under ``spark.checkpoint.dir`` and re-read, so the final overwrite
never reads the partitions it is replacing and a lost executor can always recompute its
task from the staged copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import CSV_DIALECT
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS, FACT_SCHEMA
from pulsegrid.session import drop_scratch, path_exists, scratch_path

FACT_SORT = ["activity_date", "country", "platform", "user_id"]

# Fixed value: DDL of the fact table for catalog-managed deployments (K8). Parquet tables
# enforce neither uniqueness nor NOT NULL; loads check both before they commit (``enforce_fact``).
FACT_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  activity_date DATE NOT NULL,
  user_id STRING NOT NULL,
  country STRING NOT NULL,
  platform STRING NOT NULL
) USING parquet
PARTITIONED BY (activity_date)"""


def create_fact_table(spark: SparkSession, name: str, location: str | None = None, buckets: int | None = None) -> None:
    """K8: register the fact table in the catalog (optionally at an explicit location). With
    ``buckets`` the rows of each date are clustered by user, so joins and merges on the user
    read them without a shuffle."""
    from pulsegrid.config import check_table_name

    ddl = FACT_DDL.format(name=check_table_name(name))
    if buckets:
        ddl += f"\nCLUSTERED BY (user_id) SORTED BY (user_id) INTO {int(buckets)} BUCKETS"
    if location:
        ddl += f"\nLOCATION '{location}'"
    spark.sql(ddl)


def layout_fact(fact: DataFrame) -> DataFrame:
    """Rebalance by date, then sort each task's rows for clustering.

    ``REBALANCE`` hash-partitions by the write's partition column and lets AQE split any
    partition above the advisory size into several tasks (a date holding a third of all rows
    is written by many tasks, not one) and merge small ones (no small-file explosion). Unlike
    a range repartition it needs no sampling pass over the data."""
    return fact.select(*FACT_COLUMNS).hint("rebalance", "activity_date").sortWithinPartitions(*FACT_SORT)


def write_fact(fact: DataFrame, path: str, dynamic: bool = True) -> None:
    """K3: write the fact partitioned by date; with ``dynamic`` only the dates present in
    ``fact`` are replaced and every other date survives."""
    (
        layout_fact(fact)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("activity_date")
        .parquet(path)
    )


# Error conditions that mean "no table written there yet"; anything else is re-raised.
_ABSENT_TABLE_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_absent(err: AnalysisException) -> bool:
    return (err.getCondition() or "") in _ABSENT_TABLE_CONDITIONS


def _existing(spark: SparkSession, path: str, columns: list[str]) -> DataFrame | None:
    """What is stored at ``path``, or None when nothing has been written there yet."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path).select(*columns)
    except AnalysisException as err:
        if table_absent(err):
            return None
        raise


def read_fact_if_exists(spark: SparkSession, path: str) -> DataFrame:
    """The fact table at ``path``; empty when nothing has been written there yet."""
    stored = _existing(spark, path, FACT_COLUMNS)
    return spark.createDataFrame([], FACT_SCHEMA) if stored is None else stored


def without_keys(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``rows`` whose key is not in ``keyed``: an anti join by sorting, which spills.

    A broadcast would hold all keys in every task, and the optimizer would choose it by the size of
    the files: dictionaries and runs make a few MB of Parquet out of keys that need a GB as rows."""
    return rows.join(keyed.select(*keys).hint("merge"), keys, "left_anti")


def merge_rows(new: DataFrame, old: DataFrame, mode: str = "replace") -> DataFrame:
    """The rows of the touched dates after a load.

    * ``replace`` (K9, insert-or-replace on the key): new rows win; old rows whose key is
      absent from the batch stay.
    * ``insert_only`` (K10, MERGE ... WHEN NOT MATCHED THEN INSERT): old rows win; only new
      keys are added.
    Both are one anti join on the three key columns plus a union.
    """
    new = new.select(*FACT_COLUMNS)
    old = old.select(*FACT_COLUMNS)
    if mode == "replace":
        return new.unionByName(without_keys(old, new, FACT_KEYS))
    if mode == "insert_only":
        return old.unionByName(without_keys(new, old, FACT_KEYS))
    raise ValueError(f"unknown upsert mode {mode!r}")


def touched_partitions(old: DataFrame, batch: DataFrame, partition_by: str) -> DataFrame:
    """The rows of ``old`` in the partitions that ``batch`` (a written table) has rows for: a
    static filter on its least and greatest value, then exactly its values."""
    ends = batch.agg(F.min(partition_by).alias("a"), F.max(partition_by).alias("b")).first()
    inside = old.where(F.col(partition_by).between(F.lit(ends.a), F.lit(ends.b)))
    return inside.join(batch.select(partition_by).distinct(), partition_by, "left_semi")


def _commit(spark: SparkSession, path: str, scratch: list[str], write) -> None:
    """Run the final write, then drop the scratch folders. If the write fails the merged rows
    are still there, and the error says where and how to finish."""
    try:
        write()
    except Exception as err:
        raise RuntimeError(
            f"replacing partitions of {path} failed; the merged rows are complete in {scratch[-1]}: "
            f"read that folder and write it again with write_fact or replace_rows") from err
    drop_scratch(spark, *scratch)
    spark.catalog.refreshByPath(path)


def upsert_fact(spark: SparkSession, new: DataFrame, path: str, mode: str = "replace",
                audit: Callable[[DataFrame], None] | None = None) -> None:
    """Load a batch into the fact table at ``path``. ``audit`` sees the rows that the touched
    dates are about to have; if it raises, the table stays as it is. (``publish.publish_load``
    does the same through the catalog, a whole date at a time.)

    The batch is written once to scratch; its dates, its keys and its rows are read from there,
    so its sources are scanned once. Only the dates it has rows for are read and replaced, and
    every row of those dates stays unless the batch replaces its key. An empty batch changes
    nothing. The scratch folders go when the load is committed."""
    batch_path = scratch_path(spark, "fact-batch")
    new.select(*FACT_COLUMNS).write.mode("overwrite").parquet(batch_path)
    batch = spark.read.schema(FACT_SCHEMA).parquet(batch_path)
    old = _existing(spark, path, FACT_COLUMNS)
    scratch, merged = [batch_path], batch
    if batch.isEmpty():
        drop_scratch(spark, batch_path)
        return
    if old is not None:
        scratch.append(scratch_path(spark, "fact-merge"))
        merge_rows(batch, touched_partitions(old, batch, "activity_date"), mode).write.mode("overwrite").parquet(scratch[1])
        merged = spark.read.schema(FACT_SCHEMA).parquet(scratch[1])
    if audit is not None:
        try:
            audit(merged)
        except BaseException:
            drop_scratch(spark, *scratch)
            raise
    _commit(spark, path, scratch, lambda: write_fact(merged, path))


def replace_rows(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: list[str],
    partition_by: str,
    sort_by: list[str] | None = None,
) -> None:
    """Generic insert-or-replace on ``keys`` for a Parquet table partitioned by
    ``partition_by`` (used by the streaming sinks): only the partitions the batch touches are
    read, merged, staged and overwritten."""
    cols, schema = new.columns, new.schema
    sort_by = sort_by or [partition_by, *[k for k in keys if k != partition_by]]
    scratch = [scratch_path(spark, "batch")]
    new.write.mode("overwrite").parquet(scratch[0])
    rows = spark.read.schema(schema).parquet(scratch[0]).select(*cols)
    if rows.isEmpty():
        drop_scratch(spark, *scratch)
        return
    old = _existing(spark, path, cols)
    if old is not None:
        kept = without_keys(touched_partitions(old, rows, partition_by), rows, keys)
        scratch.append(scratch_path(spark, "merge"))
        rows.unionByName(kept).write.mode("overwrite").parquet(scratch[1])
        rows = spark.read.schema(schema).parquet(scratch[1]).select(*cols)
    _commit(spark, path, scratch, lambda: (
        rows.hint("rebalance", partition_by).sortWithinPartitions(*sort_by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by).parquet(path)))


def append_new_keys(spark: SparkSession, new: DataFrame, path: str, keys: list[str], partition_by: str) -> DataFrame:
    """Add the rows of ``new`` (unique on ``keys``, a written table) whose key is not stored
    yet, and return their partition values. Stored rows are never rewritten, so a small batch
    into a large partition costs one anti join and one small file. Doing it again adds nothing."""
    cols = new.columns
    added_path = scratch_path(spark, "added")
    old = None if new.isEmpty() else _existing(spark, path, cols)
    fresh = new if old is None else without_keys(new, touched_partitions(old, new, partition_by), keys)
    fresh.select(*cols).write.mode("overwrite").parquet(added_path)
    added = spark.read.schema(new.schema).parquet(added_path)
    if not added.isEmpty():
        added.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(path)
        spark.catalog.refreshByPath(path)
    return added.select(partition_by).distinct()


def export_fact_csv(fact: DataFrame, path: str) -> None:
    """K4: the fact as CSV with header, ordered by (date, user, platform). A global sort is a
    range shuffle; files are written in key order."""
    fact.select(*FACT_COLUMNS).orderBy(*FACT_KEYS).write.mode("overwrite").options(**CSV_DIALECT).csv(path)
