"""Filter predicates. Bounds are driver-side literals so Parquet scans can prune."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _midnight(d: date | datetime) -> datetime:
    return d if isinstance(d, datetime) else datetime.combine(d, time.min)


def ntz_literal(value: date | datetime) -> Column:
    """A naive timestamp literal built from ISO text. A Python ``datetime`` literal would be
    converted through the driver process's local time zone; text cast to ``timestamp_ntz``
    is the same wall-clock value on any driver."""
    return F.lit(_midnight(value).isoformat()).cast("timestamp_ntz")


def event_time_window(ts: Column | str, start: date, end: date) -> Column:
    """Half-open ``start <= ts < end``; NULL (unparseable) timestamps pass through so the
    quality layer can count them."""
    c = _col(ts)
    lo, hi = ntz_literal(start), ntz_literal(end)
    return c.isNull() | ((c >= lo) & (c < hi))


def strict_event_time_window(ts: Column | str, start: date, end: date) -> Column:
    """Half-open window without the NULL bypass (typed, landed data)."""
    c = _col(ts)
    lo, hi = ntz_literal(start), ntz_literal(end)
    return (c >= lo) & (c < hi)


def date_range(col: Column | str, start: date | None = None, end: date | None = None) -> Column:
    """``BETWEEN start AND end``, both inclusive; either side optional."""
    c = _col(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c <= F.lit(end))
    return cond


def equals_if_given(col: Column | str, value) -> Column:
    """Optional equality filter; ``None`` or ``"All"`` means no filter."""
    if value is None or value == "All":
        return F.lit(True)
    return _col(col) == F.lit(value)
