"""Fixed values.

The values in the first block must equal the reference's for results to match; they are
stated here once, in their natural order, and imported everywhere else. The second block
holds this engine's own fixed choices.
"""

# ---- Fixed values that must match the reference ----

# Quarantine reasons, in canonical (first-match) order.
DQ_REASONS = (
    "null_user_id",
    "null_timestamp",
    "invalid_timestamp",
    "null_platform",
    "negative_duration",
)

# Country for a session whose account is missing or has no country.
UNKNOWN_COUNTRY = "UNKNOWN"

# Raw session timestamp format (naive UTC), as a Spark datetime pattern.
RAW_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# Run window: default length in days (start = end - 29) and default look-back in days.
DEFAULT_WINDOW_DAYS = 30
DEFAULT_REPROCESS_DAYS = 7

# Rows per JDBC round trip when reading accounts.
JDBC_FETCH_SIZE = 10_000

# A table name must be a plain identifier.
TABLE_NAME_PATTERN = r"^[A-Za-z_][A-Za-z0-9_]*$"

# Span of the date axis in years = days / 365.25, shown with one decimal.
DAYS_PER_YEAR = 365.25

# Peak hourly CCU is chosen after rounding to one decimal; its label is the hour as HH:mm.
PEAK_CCU_DECIMALS = 1
HOUR_LABEL_FORMAT = "HH:mm"

# The run summary shows the last 5 days of DAU and the top 5 countries.
SUMMARY_TOP_N = 5

# The dashboard's platform list: its order, and what is shown as zero when absent.
PLATFORM_ORDER = ("Windows", "Android", "iOS")

# ---- This engine's own fixed choices ----

# A line that is not a JSON document is a reason of its own, after the canonical ones. (The
# reference stops at such a line.)
MALFORMED_REASON = "malformed_record"

# CSV as RFC 4180 has it: a header, and a quote inside quotes doubled.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}

# Files one micro-batch of a stream takes at most.
MAX_FILES_PER_TRIGGER = 1_000

# Why a CCU minute cannot be used: it belongs to no hour, or its value is no number.
CCU_REJECTS = ("bad_time", "bad_value")

# Hours that the watermark of the hourly CCU stream waits for minutes that come late.
CCU_LATENESS_HOURS = 2

# Blank = only space separators (``\z``, not ``$``, so a lone newline is not blank).
BLANK_PATTERN = r"^\p{Zs}*\z"

# Guard in front of the lenient timestamp cast: rejects bare years, year-months and times.
TIMESTAMP_GUARD = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]|\s*$)"

# Scale of the exact decimal sum behind hourly means.
CCU_SUM_DECIMAL = "decimal(38,9)"
