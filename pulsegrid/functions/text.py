"""Blank / empty tests on string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.constants import BLANK_PATTERN  # only space separators; ``trim`` strips just U+0020


def is_blank(col: Column | str) -> Column:
    """NULL, empty, or only space separators: the quality layer's notion of a missing value.

    Same result as ``rlike(BLANK_PATTERN)``, with the regex kept off the common path: after
    trimming ASCII spaces, an empty string is blank and a string whose first remaining
    character is ASCII is not (the only ASCII space separator is U+0020); only a string that
    then starts with a non-ASCII character goes through the Unicode regex."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.trim(c)
    return c.isNull() | (F.length(t) == 0) | ((F.ascii(t) > 127) & c.rlike(BLANK_PATTERN))


def is_empty(col: Column | str) -> Column:
    """NULL or the empty string (no trimming): the strict validity notion."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (F.length(c) == 0)
