"""Job configuration and extraction-window arithmetic (driver-side dates become literals,
so partition pruning on ``activity_date`` / ``event_date`` is static)."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pulsegrid.constants import DEFAULT_REPROCESS_DAYS, DEFAULT_WINDOW_DAYS, TABLE_NAME_PATTERN

_IDENTIFIER = re.compile(TABLE_NAME_PATTERN)


def check_table_name(table: str) -> str:
    """Reject anything that is not a plain SQL identifier (guards JDBC ``dbtable``)."""
    if not _IDENTIFIER.match(table or ""):
        raise ValueError(f"Invalid table name: {table!r}")
    return table


def _as_date(value: date | str | None) -> date | None:
    if value is None or isinstance(value, date):
        return value
    return date.fromisoformat(str(value))


@dataclass(frozen=True)
class Window:
    """Run window. ``end_date`` is an inclusive calendar day; extraction is half-open
    ``[start - reprocess_days, end + 1 day)``."""

    end_date: date
    start_date: date | None = None
    reprocess_days: int = DEFAULT_REPROCESS_DAYS

    def __post_init__(self):
        object.__setattr__(self, "end_date", _as_date(self.end_date))
        start = _as_date(self.start_date)
        if start is None:
            start = self.end_date - timedelta(days=DEFAULT_WINDOW_DAYS - 1)
        object.__setattr__(self, "start_date", start)
        if self.reprocess_days < 0:
            raise ValueError("reprocess_days must be >= 0")

    @property
    def extract_start(self) -> date:
        return self.start_date - timedelta(days=self.reprocess_days)

    @property
    def extract_end(self) -> date:
        """Exclusive upper bound of the extraction window."""
        return self.end_date + timedelta(days=1)


@dataclass(frozen=True)
class JobConfig:
    """Everything a run needs. Precedence: explicit overrides > environment > defaults."""

    window: Window
    accounts_path: str | None = None
    accounts_format: str = "csv"  # csv | parquet | jdbc
    sessions_path: str | None = None
    sessions_format: str = "json"  # json | parquet | landed
    ccu_path: str | None = None
    jdbc_url: str | None = None
    jdbc_table: str = "accounts"
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_partitions: int = 8
    fact_path: str | None = None
    fact_table: str | None = None  # a catalog table: loads are then published through the catalog
    raw_path: str | None = None
    quarantine_path: str | None = None
    output_dir: str | None = None
    upsert_mode: str = "replace"  # replace | insert_only

    @classmethod
    def from_env(cls, env: dict | None = None, **overrides) -> "JobConfig":
        env = os.environ if env is None else env
        end = overrides.pop("end_date", None) or env.get("PULSEGRID_END_DATE")
        if end is None:
            raise ValueError("an end date is required (PULSEGRID_END_DATE or end_date=)")
        start = overrides.pop("start_date", None) or env.get("PULSEGRID_START_DATE") or None
        reprocess = overrides.pop("reprocess_days", None)
        if reprocess is None:
            reprocess = int(env.get("PULSEGRID_REPROCESS_DAYS", DEFAULT_REPROCESS_DAYS))
        jdbc_url = env.get("PULSEGRID_JDBC_URL") or None
        cfg = cls(
            window=Window(end_date=end, start_date=start, reprocess_days=int(reprocess)),
            accounts_path=env.get("PULSEGRID_ACCOUNTS_PATH"),
            accounts_format="jdbc" if jdbc_url else env.get("PULSEGRID_ACCOUNTS_FORMAT", "csv"),
            sessions_path=env.get("PULSEGRID_SESSIONS_PATH"),
            sessions_format=env.get("PULSEGRID_SESSIONS_FORMAT", "json"),
            ccu_path=env.get("PULSEGRID_CCU_PATH"),
            jdbc_url=jdbc_url,
            jdbc_table=check_table_name(env.get("PULSEGRID_JDBC_TABLE", "accounts")),
            jdbc_user=env.get("PULSEGRID_JDBC_USER"),
            jdbc_password=env.get("PULSEGRID_JDBC_PASSWORD"),
            fact_path=env.get("PULSEGRID_FACT_PATH"),
            fact_table=check_table_name(env["PULSEGRID_FACT_TABLE"]) if env.get("PULSEGRID_FACT_TABLE") else None,
            raw_path=env.get("PULSEGRID_RAW_PATH"),
            quarantine_path=env.get("PULSEGRID_QUARANTINE_PATH"),
            output_dir=env.get("PULSEGRID_OUTPUT_DIR"),
            upsert_mode=env.get("PULSEGRID_UPSERT_MODE", "replace"),
        )
        return replace(cfg, **overrides) if overrides else cfg
