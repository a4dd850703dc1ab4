"""T2 with bounded state: raw sessions -> routes -> distinct grain keys by a state store -> fact.

A key (day, user, platform) is remembered from its first session until the watermark is a
look-back past it, so neither the state nor the work of a micro-batch grows with the stored
table, which is only appended to. Sessions that come later than the look-back are routed to a
side table and counted. After the stream they are merged by insert-only MERGE (K10): one anti
join with the stored keys of their own days. So nothing is lost, and the result is the batch
result whatever the order of the sessions.

The table is laid out by day and load. Every micro-batch and every merge is a load of its own
and rewrites only that when it is run again, so each key is stored once.

With a catalog table (K3, K9) what a run has gathered is published there when it is done, days
merged and written anew in files of a good size, and the run's own small files go. So the
number of files does not grow with the number of micro-batches, and a reader of the catalog
table finds every day as it was or as it is.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.constants import DEFAULT_REPROCESS_DAYS, MAX_FILES_PER_TRIGGER
from pulsegrid.functions.timestamps import activity_date
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.activity import attach_country
from pulsegrid.operators.publish import publish_load
from pulsegrid.operators.quality import classify_sessions
from pulsegrid.operators.tables import read_fact_if_exists, touched_partitions, without_keys
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS, SESSION_FIELDS, SESSIONS_JSON_SCHEMA
from pulsegrid.session import drop_scratch, path_exists, scratch_path, stage
from pulsegrid.sources.readers import session_columns
from pulsegrid.streaming import routing as R

ROUTED_SCHEMA = "user_id string, timestamp string, duration double, platform string, ts timestamp_ntz, reject string"


def _keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("activity_date", activity_date("ts"))


def run_fact_state_stream(
    spark: SparkSession,
    landing_path: str,
    accounts: DataFrame,
    base: str,
    look_back: timedelta = timedelta(days=DEFAULT_REPROCESS_DAYS),
    horizon: datetime | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    table: str | None = None,
) -> DataFrame:
    """Process what has landed since the last run on ``base`` and return the fact table: the
    one under ``base``, or the catalog table ``table``, which must exist.

    ``look_back`` is at least a day: a key's sessions lie within one day, so a key leaves the
    state only when all its further sessions are late. ``horizon`` keeps sessions at or after
    it out of the watermark; they are merged like late ones."""
    if look_back < timedelta(days=1):
        raise ValueError("the look-back must be a day or more")
    base = base.rstrip("/")
    if path_exists(spark, f"{base}/fact") and not path_exists(spark, f"{base}/checkpoints/state"):
        raise ValueError(f"{base} has a fact table but no state to go on from")
    accounts_one = stage(spark, latest_account_per_user(accounts), "stream-accounts")

    raw = spark.readStream.schema(SESSIONS_JSON_SCHEMA).option("mode", "PERMISSIVE") \
        .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_path)
    R.run_router(spark, classify_sessions(session_columns(raw)).withColumnRenamed("dq_reason", "reject"), base, look_back, horizon)

    def load(batch: DataFrame, epoch: int) -> None:
        # One write, so the state is brought up to date once. Its tasks, as many as the state has parts,
        # write a file each; what is read from these is joined and laid out by day adaptively.
        path = scratch_path(spark, "stream-keys")
        try:
            batch.write.mode("overwrite").parquet(path)
            keys = spark.read.schema(batch.schema).parquet(path)
            if not keys.isEmpty():
                R.write_slices(attach_country(keys, accounts_one).select(*FACT_COLUMNS), f"{base}/fact", "activity_date", f"batch-{epoch}")
        finally:
            drop_scratch(spark, path)

    if path_exists(spark, f"{base}/routed"):
        R.run_stateful(spark, base, ROUTED_SCHEMA, look_back,
                       lambda rows: _keys(rows).dropDuplicatesWithinWatermark(FACT_KEYS).select(*FACT_KEYS), load)
        first, last = R.side_epochs(spark, base)
        merge_side(spark, base, accounts_one, first, last)
        R.drop_on_time(spark, base, list(range(first, last + 1)))
    if table is None:
        return read_state_fact(spark, base)
    publish_slices(spark, base, table)
    return spark.table(table).select(*FACT_COLUMNS)


def publish_slices(spark: SparkSession, base: str, table: str) -> None:
    """Merge what the stream has gathered into the catalog table, keys that are there already
    staying as they are, then delete the slices. A run that is lost in between publishes the
    same rows again, which changes nothing."""
    slices = f"{base}/fact"
    if path_exists(spark, slices):
        publish_load(spark, read_state_fact(spark, base), table, mode="insert_only")
        path = spark._jvm.org.apache.hadoop.fs.Path(slices)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        spark.catalog.refreshByPath(slices)


def merge_side(spark: SparkSession, base: str, accounts_one: DataFrame, first: int, last: int) -> None:
    """K10 for the late and ahead sessions of the micro-batches from ``first`` to ``last``: keys that no load has stored are added."""
    if first > last:
        return
    slice_name = f"side-{first}-{last}"
    side = R.routed(spark, base, ROUTED_SCHEMA, R.LATE, R.AHEAD).where(F.col("epoch").between(first, last))
    keys = stage(spark, _keys(side).select(*FACT_KEYS).distinct(), "stream-side")
    if not keys.isEmpty():
        fresh = keys
        if path_exists(spark, f"{base}/fact"):
            stored = spark.read.parquet(f"{base}/fact").where(F.col("load") != slice_name)
            fresh = without_keys(keys, touched_partitions(stored, keys, "activity_date"), FACT_KEYS)
        added = stage(spark, attach_country(fresh, accounts_one).select(*FACT_COLUMNS), "stream-side-fact")
        R.write_slices(added, f"{base}/fact", "activity_date", slice_name)
    R.side_merged(spark, base, last)


def read_state_fact(spark: SparkSession, base: str) -> DataFrame:
    return read_fact_if_exists(spark, f"{base.rstrip('/')}/fact")


def late_sessions(spark: SparkSession, base: str) -> DataFrame:
    """``(route, event_date, n)``: sessions that came later than the look-back, or lie ahead."""
    return R.side_counts(spark, base.rstrip("/"), ROUTED_SCHEMA)


def quarantined(spark: SparkSession, base: str) -> DataFrame:
    """What the stream set aside: the raw fields and the reason."""
    return R.routed(spark, base.rstrip("/"), ROUTED_SCHEMA, R.REJECTED).select(*SESSION_FIELDS, F.col("reject").alias("dq_reason"))
