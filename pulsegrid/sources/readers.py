"""Scans (S1-S8). Always an explicit schema; projections and filters are declared so
Catalyst pushes them into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import JobConfig, Window, check_table_name
from pulsegrid.constants import CCU_REJECTS, CSV_DIALECT, JDBC_FETCH_SIZE, RAW_TIMESTAMP_FORMAT
from pulsegrid.functions.predicates import event_time_window, strict_event_time_window
from pulsegrid.functions.timestamps import parse_event_time
from pulsegrid.schemas import (
    ACCOUNT_FIELDS,
    ACCOUNTS_SCHEMA,
    CCU_CSV_SCHEMA,
    FACT_COLUMNS,
    SESSION_FIELDS,
    SESSIONS_JSON_SCHEMA,
)


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Accounts CSV export with header; all four fields as text."""
    return spark.read.schema(ACCOUNTS_SCHEMA).options(**CSV_DIALECT).csv(path)


# Default split expression for the accounts source database (PostgreSQL): the key is a
# string, so there is no numeric ``partitionColumn``; partitions are hash buckets instead.
# Uses documented functions only: the first 7 hex digits of md5 as a 28-bit, non-negative int.
DEFAULT_JDBC_HASH_SQL = "('x' || SUBSTR(MD5(user_id), 1, 7))::bit(28)::int"


def jdbc_account_predicates(partitions: int, hash_sql: str = DEFAULT_JDBC_HASH_SQL) -> list[str]:
    """One WHERE clause per partition (one connection each); NULL keys get their own."""
    n = max(1, int(partitions))
    return [f"MOD({hash_sql}, {n}) = {i}" for i in range(n)] + ["user_id IS NULL"]


def jdbc_account_options(url: str, table: str, user: str | None, password: str | None) -> dict:
    opts = {
        "url": url,
        "dbtable": f"(SELECT {', '.join(ACCOUNT_FIELDS)} FROM {check_table_name(table)}) accounts_src",
        "fetchsize": str(JDBC_FETCH_SIZE),
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def read_accounts_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partitions: int = 8,
    hash_sql: str = DEFAULT_JDBC_HASH_SQL,
) -> DataFrame:
    """Accounts table over JDBC, read in parallel by hash predicates."""
    opts = jdbc_account_options(url, table, user, password)
    props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    df = spark.read.jdbc(
        url=opts["url"], table=opts["dbtable"],
        predicates=jdbc_account_predicates(partitions, hash_sql), properties=props,
    )
    return df.select(*[F.col(c).cast("string").alias(c) for c in ACCOUNT_FIELDS])


def session_columns(df: DataFrame) -> DataFrame:
    """Rows of SESSIONS_JSON_SCHEMA -> raw sessions plus boolean ``malformed`` and, where it is
    set, the ``line`` as it stands: the one policy for JSON sessions, batch, stream and message
    bus. A duration that is no number is NULL."""
    return df.withColumn("duration", F.col("duration").try_cast("double")).withColumn(
        "malformed", F.col("_corrupt_record").isNotNull()).withColumn("line", F.col("_corrupt_record")).drop("_corrupt_record")


def sessions_from_records(records: DataFrame, value: str = "value") -> DataFrame:
    """JSON session documents in a string column, as a message bus brings them -> raw
    sessions with ``malformed`` and ``line``, by the policy of the file source. A record may be
    any JSON object; NULL and blank records are no sessions, as blank lines are none."""
    text = records.where(F.trim(F.col(value)) != "").select(F.from_json(
        value, SESSIONS_JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("s"))
    return session_columns(text.select("s.*"))


def read_sessions_json(spark: SparkSession, path: str, window: Window | None = None) -> DataFrame:
    """JSON-lines sessions (blank lines skipped, unknown fields ignored), optionally
    restricted to the extraction window with unparseable timestamps let through (F2).

    A line that is no JSON document comes out with ``malformed`` set and is quarantined under
    its own reason; a quoted number counts as the number."""
    df = session_columns(spark.read.schema(SESSIONS_JSON_SCHEMA).option("mode", "PERMISSIVE").json(path))
    if window is not None:
        if "event_date" in df.columns:
            # Landed by event date: prune directories first (a partition filter), then the
            # exact half-open window on the parsed timestamp.
            d = F.col("event_date")
            df = df.where(d.isNull() | ((d >= F.lit(window.extract_start)) & (d < F.lit(window.extract_end))))
        df = df.where(event_time_window(parse_event_time("timestamp"), window.extract_start,
                                        window.extract_end))
    return df.select(*SESSION_FIELDS, "malformed", "line")


def read_landed_sessions(spark: SparkSession, path: str, window: Window | None = None) -> DataFrame:
    """Typed sessions landed partitioned by ``event_date``. The window becomes a
    partition filter plus a pushed timestamp filter; the output is raw-shaped (text
    timestamp) so it feeds the same quality step."""
    df = spark.read.parquet(path)
    if window is not None:
        df = df.where(
            (F.col("event_date") >= F.lit(window.extract_start))
            & (F.col("event_date") < F.lit(window.extract_end))
            & strict_event_time_window("timestamp", window.extract_start, window.extract_end)
        )
    return df.select(
        "user_id",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "duration",
        "platform",
    )


def ccu_columns(df: DataFrame) -> DataFrame:
    """CSV text rows -> ``(ts, ccu, reject)``. ``reject`` says why a minute cannot be used:
    ``bad_time`` (no or no valid timestamp: it belongs to no hour) or ``bad_value`` (text that
    is no number). An empty value is a missing measurement, which a mean leaves out."""
    ts, ccu = parse_event_time("timestamp"), F.col("ccu").try_cast("double")
    bad_time, bad_value = CCU_REJECTS
    reject = F.when(ts.isNull(), F.lit(bad_time)).when(F.col("ccu").isNotNull() & ccu.isNull(), F.lit(bad_value))
    return df.select(ts.alias("ts"), ccu.alias("ccu"), reject.alias("reject"))


def read_ccu_csv(spark: SparkSession, path: str) -> DataFrame:
    """Minute CCU CSV -> ``(ts, ccu, reject)``; see :func:`ccu_columns`."""
    return ccu_columns(spark.read.schema(CCU_CSV_SCHEMA).options(**CSV_DIALECT).csv(path))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Fact Parquet; the partition column is re-ordered into place by the select."""
    return spark.read.parquet(path).select(*FACT_COLUMNS)


def read_sessions_parquet(spark: SparkSession, path: str, window: Window) -> DataFrame:
    """Sessions from Parquet, in raw form. A typed timestamp is compared before it is made
    text, so the window reaches the scan as a pushed filter; an ``event_date`` partition
    column prunes folders. NULL timestamps pass, to be quarantined."""
    df = spark.read.parquet(path)
    if "event_date" in df.columns:
        d = F.col("event_date")
        df = df.where(d.isNull() | ((d >= F.lit(window.extract_start)) & (d < F.lit(window.extract_end))))
    kind = df.schema["timestamp"].dataType.simpleString()
    if kind.startswith("timestamp"):
        df = df.where(F.col("timestamp").isNull() | strict_event_time_window("timestamp", window.extract_start, window.extract_end))
        text = F.date_format("timestamp", RAW_TIMESTAMP_FORMAT)
    else:
        df = df.where(event_time_window(parse_event_time("timestamp"), window.extract_start, window.extract_end))
        text = F.col("timestamp").cast("string")
    return df.select(F.col("user_id").cast("string").alias("user_id"), text.alias("timestamp"),
                     F.col("duration").cast("double").alias("duration"), F.col("platform").cast("string").alias("platform"))


def read_accounts(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Pick the accounts reader from configuration (JDBC when a URL is set)."""
    if cfg.accounts_format == "jdbc" or cfg.jdbc_url:
        return read_accounts_jdbc(spark, cfg.jdbc_url, cfg.jdbc_table, cfg.jdbc_user,
                                  cfg.jdbc_password, cfg.jdbc_partitions)
    if cfg.accounts_format == "parquet":
        return spark.read.parquet(cfg.accounts_path).select(
            *[F.col(c).cast("string").alias(c) for c in ACCOUNT_FIELDS])
    return read_accounts_csv(spark, cfg.accounts_path)


def read_sessions(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Pick the sessions reader; every reader applies the run's extraction window."""
    if cfg.sessions_format == "landed":
        return read_landed_sessions(spark, cfg.sessions_path, cfg.window)
    if cfg.sessions_format == "parquet":
        return read_sessions_parquet(spark, cfg.sessions_path, cfg.window)
    return read_sessions_json(spark, cfg.sessions_path, cfg.window)
