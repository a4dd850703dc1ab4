"""One local Spark session, and small builders that state test data as Spark rows or files."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsegrid.schemas import ACCOUNTS_SCHEMA  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

SF_TINY = "/root/testdata/sf0.001"
VISIT = "user_id string, timestamp string, duration double, platform string"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="pulsegrid-tests", shuffle_partitions=4)
    yield s
    s.stop()


def visits(spark, *rows):
    """Raw sessions from (user, time, seconds, platform) tuples."""
    return spark.createDataFrame(list(rows), VISIT)


def members(spark, *rows):
    """Accounts from (user, country) or (user, country, updated_at) tuples."""
    full = [(r[0], r[1], "2025-03-01T00:00:00", r[2] if len(r) > 2 else "2025-03-01T00:00:00") for r in rows]
    return spark.createDataFrame(full, ACCOUNTS_SCHEMA)


def json_lines(path, *rows):
    """Write (user, time, seconds, platform) tuples, or text lines as they are, as JSON lines."""
    names = ("user_id", "timestamp", "duration", "platform")
    lines = [r if isinstance(r, str) else json.dumps(dict(zip(names, r, strict=True))) for r in rows]
    path.write_text("".join(f"{line}\n" for line in lines))
    return str(path)


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
