"""Mapping of the shared parquet tables onto this engine's inputs.

* sessions     <- ``events``: user_id, ts (as raw text), value as duration, event_type as platform
* accounts     <- ``customer`` joined to ``nation``: c_custkey as user_id, n_name as country
* detailed_ccu <- ``events``: (ts, value) as (timestamp, ccu)

The tables are clean, so the dirt the quality layer exists for is injected by expression,
row by row, over the whole table (nothing is filtered away to make anything cheaper).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.timestamps import format_raw_timestamp

# Dirt injection rules on ``event_id`` (sessions) and ``c_custkey`` (accounts).
NULL_USER_EVERY = 97
NULL_TIMESTAMP_EVERY = 89
BAD_TIMESTAMP_EVERY = 83
BLANK_PLATFORM_EVERY = 79
NEGATIVE_DURATION_EVERY = 73
DUPLICATE_EVERY = 50
NULL_DURATION_EVERY = 71
BLANK_USER_EVERY = 67
NULL_PLATFORM_EVERY = 61
SPACE_TIMESTAMP_EVERY = 59  # "yyyy-MM-dd HH:mm:ss": the lenient parser takes it, the strict one does not
MALFORMED_LINE_EVERY = 53  # JSON lines only: cut short
QUOTED_DURATION_EVERY = 47  # JSON lines only: the number as a string
BAD_MINUTE_EVERY = 43  # CCU CSV only: a timestamp that is none
BAD_CCU_EVERY = 41  # CCU CSV only: a value that is no number
GAP_DAY = "2024-01-14"  # sessions of this day happen a day later, so the axis has a gap
BAD_TIMESTAMP_TEXT = "not-a-date"
BAD_CCU_TEXT = "n/a"
SPACE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
BLANK_PLATFORM_TEXT = "  "

NO_ACCOUNT_EVERY = 10  # orphans: these customers' accounts carry a closed-account id no session uses
CLOSED_ACCOUNT_SUFFIX = "-closed"
NULL_COUNTRY_EVERY = 7
NEWER_ACCOUNT_EVERY = 11  # a second, newer account row with another country
TIED_ACCOUNT_EVERY = 13  # a second account row with the same updated_at, another country
MOVED_ACCOUNT_EVERY = 4  # snapshot 2 only: key % 4 == 1 moves country
NATION_COUNT = 25

ACCOUNT_CREATED_AT = "2023-01-01T00:00:00"
ACCOUNT_UPDATED_AT = "2023-06-01T00:00:00"
NEWER_UPDATED_AT = "2023-12-01T00:00:00"
MOVED_UPDATED_AT = "2024-02-01T00:00:00"


# Schemas of the shared tables this engine reads (declared, so the scan does
# not open file footers to infer them).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _session_fields(dirty: bool) -> list:
    eid = F.col("event_id")
    user = F.col("user_id").cast("string")
    ts = format_raw_timestamp("ts")
    duration = F.col("value")
    platform = F.col("event_type")
    if dirty:
        moved = F.when(F.col("ts").cast("date") == F.lit(GAP_DAY).cast("date"), F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts"))
        user = F.when(eid % NULL_USER_EVERY == 0, F.lit(None).cast("string")).when(
            eid % BLANK_USER_EVERY == 0, F.lit("")).otherwise(user)
        ts = (
            F.when(eid % NULL_TIMESTAMP_EVERY == 0, F.lit(None).cast("string"))
            .when(eid % BAD_TIMESTAMP_EVERY == 0, F.lit(BAD_TIMESTAMP_TEXT))
            .when(eid % SPACE_TIMESTAMP_EVERY == 0, F.date_format(moved, SPACE_TIMESTAMP_FORMAT))
            .otherwise(format_raw_timestamp(moved))
        )
        duration = F.when(eid % NULL_DURATION_EVERY == 0, F.lit(None).cast("double")).when(
            eid % NEGATIVE_DURATION_EVERY == 0, -duration).otherwise(duration)
        platform = F.when(eid % BLANK_PLATFORM_EVERY == 0, F.lit(BLANK_PLATFORM_TEXT)).when(
            eid % NULL_PLATFORM_EVERY == 0, F.lit(None).cast("string")).otherwise(platform)
    return [user.alias("user_id"), ts.alias("timestamp"), duration.cast("double").alias("duration"), platform.alias("platform")]


def sessions_from_events(events: DataFrame, dirty: bool = True) -> DataFrame:
    """Raw sessions ``(user_id, timestamp, duration, platform)`` as text/double.

    With ``dirty``: NULL and blank users, NULL, malformed and space-form timestamps, blank and
    NULL platforms, NULL and negative durations on fixed ``event_id`` residues, a day without
    sessions, and every 50th event twice (duplicate sessions, from one scan via ``explode``).
    """
    if not dirty:
        return events.select(*_session_fields(False))
    copies = F.when(F.col("event_id") % DUPLICATE_EVERY == 0, F.lit(2)).otherwise(F.lit(1))
    return events.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).select(*_session_fields(True))


def session_lines_from_events(events: DataFrame) -> DataFrame:
    """The dirty sessions as JSON lines ``(value)``, some cut short, some with their duration quoted."""
    eid = F.col("event_id")
    fields = events.select("event_id", *_session_fields(True))
    plain = F.to_json(F.struct("user_id", "timestamp", "duration", "platform"))
    quoted = F.to_json(F.struct("user_id", "timestamp", F.col("duration").cast("string").alias("duration"), "platform"))
    return fields.select(
        F.when(eid % MALFORMED_LINE_EVERY == 0, F.lit('{"user_id": "12'))
        .when(eid % QUOTED_DURATION_EVERY == 0, quoted).otherwise(plain).alias("value"))


def accounts_from_customers(customer: DataFrame, nation: DataFrame, snapshot: int = 1) -> DataFrame:
    """Accounts export ``(user_id, country, created_at, updated_at)``, all text.

    Every customer gets a base row (country NULL on one residue); some get a second, newer
    row or a tied row with another country, so the one-account-per-user reduction has work
    to do. One residue of customers is under a closed-account id that no session uses, so
    their sessions are orphans (no row is dropped). Snapshot 2 adds a newer row that moves a
    quarter of the users to another country (for upsert scenarios).
    """
    key = F.col("c_custkey")
    variants = [
        F.struct(F.lit(True).alias("keep"), F.lit(0).alias("shift"),
                 F.lit(ACCOUNT_UPDATED_AT).alias("updated_at"),
                 (key % NULL_COUNTRY_EVERY == 0).alias("null_country")),
        F.struct((key % NEWER_ACCOUNT_EVERY == 0).alias("keep"), F.lit(1).alias("shift"),
                 F.lit(NEWER_UPDATED_AT).alias("updated_at"), F.lit(False).alias("null_country")),
        F.struct((key % TIED_ACCOUNT_EVERY == 0).alias("keep"), F.lit(2).alias("shift"),
                 F.lit(ACCOUNT_UPDATED_AT).alias("updated_at"), F.lit(False).alias("null_country")),
    ]
    if snapshot >= 2:
        variants.append(
            F.struct((key % MOVED_ACCOUNT_EVERY == 1).alias("keep"), F.lit(3).alias("shift"),
                     F.lit(MOVED_UPDATED_AT).alias("updated_at"), F.lit(False).alias("null_country"))
        )
    rows = (
        customer
        .select(key, "c_nationkey", F.explode(F.filter(F.array(*variants), lambda v: v["keep"])).alias("v"))
        .select(
            key,
            ((F.col("c_nationkey") + F.col("v.shift")) % NATION_COUNT).alias("nk"),
            F.col("v.updated_at").alias("updated_at"),
            F.col("v.null_country").alias("null_country"),
        )
    )
    # nation is a fixed 25-row dimension; the optimizer broadcasts it from its file size.
    named = rows.join(nation.select("n_nationkey", "n_name"), rows.nk == nation.n_nationkey, "left")
    user_id = F.when(key % NO_ACCOUNT_EVERY == 0, F.concat(key.cast("string"), F.lit(CLOSED_ACCOUNT_SUFFIX))) \
        .otherwise(key.cast("string"))
    return named.select(
        user_id.alias("user_id"),
        F.when(F.col("null_country"), F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country"),
        F.lit(ACCOUNT_CREATED_AT).alias("created_at"),
        F.col("updated_at"),
    )


def ccu_from_events(events: DataFrame) -> DataFrame:
    """Minute-level CCU series ``(ts, ccu)``."""
    return events.select(F.col("ts"), F.col("value").alias("ccu"))


def raw_ccu_from_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """The CCU series as its CSV export shape ``(timestamp, ccu)``, both text; with ``dirty``
    some minutes have no usable time or value."""
    eid = F.col("event_id")
    ts, ccu = format_raw_timestamp("ts"), F.col("value").cast("string")
    if dirty:
        ts = F.when(eid % BAD_MINUTE_EVERY == 0, F.lit(BAD_TIMESTAMP_TEXT)).otherwise(ts)
        ccu = F.when(eid % BAD_CCU_EVERY == 0, F.lit(BAD_CCU_TEXT)).otherwise(ccu)
    return events.select(ts.alias("timestamp"), ccu.alias("ccu"))


def quoted_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts whose countries need CSV quoting: quotes and commas."""
    return accounts.withColumn("country", F.concat(F.lit('"The", '), F.col("country"), F.lit(' "of" old')))


def load_inputs(spark: SparkSession, sf_dir: str, snapshot: int = 1, dirty: bool = True):
    """``(raw_sessions, raw_accounts)`` derived from the shared tables."""
    sessions = sessions_from_events(table(spark, sf_dir, "events"), dirty=dirty)
    accounts = accounts_from_customers(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                       snapshot=snapshot)
    return sessions, accounts
