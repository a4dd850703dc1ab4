"""Column expressions: all JVM-side, no Python UDFs."""

from pulsegrid.functions.predicates import (
    date_range,
    equals_if_given,
    event_time_window,
    strict_event_time_window,
)
from pulsegrid.functions.text import is_blank, is_empty
from pulsegrid.functions.timestamps import (
    activity_date,
    format_raw_timestamp,
    hour_bucket,
    hour_label,
    parse_event_time,
    parse_strict_timestamp,
)

__all__ = [
    "activity_date",
    "date_range",
    "equals_if_given",
    "event_time_window",
    "format_raw_timestamp",
    "hour_bucket",
    "hour_label",
    "is_blank",
    "is_empty",
    "parse_event_time",
    "parse_strict_timestamp",
    "strict_event_time_window",
]
