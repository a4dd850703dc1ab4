"""Timestamp parsing and bucketing. Everything is naive UTC (``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.constants import HOUR_LABEL_FORMAT, RAW_TIMESTAMP_FORMAT, TIMESTAMP_GUARD


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_event_time(col: Column | str) -> Column:
    """Lenient parse used by both the extraction window and the quality layer (one parser,
    so a row is either in a window or unparseable). NULL when it cannot be parsed."""
    c = _col(col)
    return F.when(c.rlike(TIMESTAMP_GUARD), c.try_cast("timestamp_ntz"))


def parse_strict_timestamp(col: Column | str) -> Column:
    """Exact ``yyyy-MM-dd'T'HH:mm:ss``; NULL otherwise. Needs a UTC session time zone."""
    return F.try_to_timestamp(_col(col), F.lit(RAW_TIMESTAMP_FORMAT)).cast("timestamp_ntz")


def format_raw_timestamp(col: Column | str) -> Column:
    return F.date_format(_col(col), RAW_TIMESTAMP_FORMAT)


def activity_date(col: Column | str) -> Column:
    """UTC calendar day of a naive timestamp."""
    return _col(col).cast("date")


def hour_bucket(col: Column | str) -> Column:
    """Start of the hour, kept as ``timestamp_ntz`` (``date_trunc`` alone returns LTZ)."""
    return F.date_trunc("hour", _col(col)).cast("timestamp_ntz")


def hour_label(col: Column | str) -> Column:
    return F.date_format(_col(col), HOUR_LABEL_FORMAT)
