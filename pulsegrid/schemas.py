"""Fixed, explicit schemas. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from pulsegrid.constants import DQ_REASONS as CANONICAL_REASONS
from pulsegrid.constants import MALFORMED_REASON, UNKNOWN_COUNTRY  # noqa: F401  (re-exported)

DQ_REASONS = (*CANONICAL_REASONS, MALFORMED_REASON)

# Accounts as exported (CSV / JDBC): timestamps stay text at the scan.
ACCOUNTS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
ACCOUNT_FIELDS = [f.name for f in ACCOUNTS_SCHEMA.fields]

# Raw sessions (JSON lines): every field may be NULL and the timestamp is text so
# malformed values survive the scan and can be classified.
SESSIONS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("platform", T.StringType()),
    ]
)
SESSION_FIELDS = [f.name for f in SESSIONS_SCHEMA.fields]

# The same as they stand in JSON lines: the duration as text, so that a quoted or odd number
# costs one value and not the read, and the line itself where it is no JSON document.
SESSIONS_JSON_SCHEMA = T.StructType(
    [
        *(f if f.name != "duration" else T.StructField("duration", T.StringType()) for f in SESSIONS_SCHEMA.fields),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

# Minute-level concurrent users as a CSV export; both as text, so that odd values are counted.
CCU_CSV_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType()), T.StructField("ccu", T.StringType())]
)

# Fact table: one row per (activity_date, user_id, platform).
FACT_SCHEMA = T.StructType(
    [
        T.StructField("activity_date", T.DateType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("platform", T.StringType(), False),
    ]
)
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]
FACT_KEYS = ["activity_date", "user_id", "platform"]
