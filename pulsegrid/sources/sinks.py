"""Landing and export sinks (K1, K2, K5, K6, K7, K12, K13). Counts come from
``DataFrame.observe`` in the same pass as the write, never from a second scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulsegrid.config import check_table_name
from pulsegrid.constants import CSV_DIALECT
from pulsegrid.functions.timestamps import activity_date, parse_event_time
from pulsegrid.schemas import ACCOUNT_FIELDS, SESSION_FIELDS


def _observed_write(df: DataFrame, name: str, write) -> int:
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def land_accounts_csv(accounts: DataFrame, path: str) -> int:
    """K1: accounts projected to the four export fields, CSV with header; returns rows."""
    return _observed_write(
        accounts.select(*ACCOUNT_FIELDS), "accounts_landed",
        lambda d: d.write.mode("overwrite").options(**CSV_DIALECT).csv(path),
    )


def land_sessions_jsonl(sessions: DataFrame, path: str, partition_by_date: bool = True) -> int:
    """K2: raw sessions as JSON lines (NULL fields omitted); returns rows.

    Partitioned by the parsed event date (unparseable timestamps land in the NULL partition),
    so a later windowed read prunes to the window's directories plus the NULL one instead of
    scanning the whole raw history. Landing is additive per date: a re-landed date replaces
    only that date."""
    out = sessions.select(*SESSION_FIELDS)
    if not partition_by_date:
        return _observed_write(out, "sessions_landed", lambda d: d.write.mode("overwrite").json(path))
    dated = out.withColumn("event_date", activity_date(parse_event_time("timestamp")))
    return _observed_write(
        dated.hint("rebalance", "event_date"), "sessions_landed",
        lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date").json(path),
    )


def session_records(sessions: DataFrame, value: str = "value") -> DataFrame:
    """Every session as one JSON document in a string column, NULL fields left out; what
    was no JSON document comes out as the line it was. Other columns stay."""
    document = F.to_json(F.struct(*SESSION_FIELDS))
    if "line" in sessions.columns:
        document = F.coalesce("line", document)
    rest = [c for c in sessions.columns if c not in (*SESSION_FIELDS, "malformed", "line")]
    return sessions.select(document.alias(value), *rest)


def land_raw_sessions(sessions: DataFrame, path: str) -> int:
    """The raw files of a run: what its source gave, malformed lines as they are, as JSON lines
    by event date (see :func:`land_sessions_jsonl`); returns rows."""
    dated = sessions.withColumn("event_date", activity_date(parse_event_time("timestamp")))
    return _observed_write(
        session_records(dated).hint("rebalance", "event_date"), "raw_sessions_landed",
        lambda d: d.write.mode("overwrite").partitionBy("event_date").text(path),
    )


def land_typed_sessions(strict_valid: DataFrame, path: str) -> int:
    """Strictly valid typed sessions partitioned by ``event_date`` (the input of the
    range scan S5), clustered by time inside each day."""
    return _observed_write(
        strict_valid.hint("rebalance", "event_date").sortWithinPartitions("event_date", "timestamp"),
        "typed_sessions_landed",
        lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date").parquet(path),
    )


def write_quarantine(quarantined: DataFrame, path: str, run: str) -> int:
    """F7 as a table: quarantined rows by run and reason. ``run`` names the run's window; a
    run replaces what an earlier run of the same window wrote, all of it, and nothing else."""
    return _observed_write(
        quarantined.hint("rebalance", "dq_reason"), "quarantine_landed",
        lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("dq_reason").parquet(f"{path.rstrip('/')}/run={run}"),
    )


def write_quality_report(report: DataFrame, path: str) -> None:
    """K5: the one-row quality report as JSON, with the quarantine counts also as a
    ``reason -> n`` map in report order (count desc, then canonical order; absent reasons
    left out)."""
    from pulsegrid.schemas import DQ_REASONS

    entries = F.array(*[F.struct(F.col(f"q_{r}").alias("n"), F.lit(-i).alias("rank"), F.lit(r).alias("reason"))
                        for i, r in enumerate(DQ_REASONS)])
    ordered = F.reverse(F.array_sort(F.filter(entries, lambda e: e["n"] > 0)))
    quarantine = F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["reason"], e["n"])))
    report.select("*", quarantine.alias("quarantine")).coalesce(1).write.mode("overwrite").json(path)


def write_hourly_ccu_csv(hourly: DataFrame, path: str) -> None:
    """K6."""
    hourly.orderBy("hour").write.mode("overwrite").options(**CSV_DIALECT).csv(path)


def export_cube_json(export_rows: DataFrame, axis: DataFrame, path: str, totals: DataFrame, lists: DataFrame) -> None:
    """K7: per-slice dense series as JSON lines, plus the axis, the totals over all days and
    the lists of countries and platforms in their order, under ``path``."""
    export_rows.write.mode("overwrite").json(f"{path}/series")
    axis.orderBy("activity_date").select(F.date_format("activity_date", "yyyy-MM-dd").alias("date")) \
        .write.mode("overwrite").json(f"{path}/axis")
    totals.orderBy("by", F.desc("users"), "name").write.mode("overwrite").json(f"{path}/totals")
    lists.orderBy("list", "position").write.mode("overwrite").json(f"{path}/lists")


def reload_accounts_jdbc(accounts: DataFrame, url: str, table: str, user: str | None = None,
                         password: str | None = None, partitions: int = 8) -> int:
    """Truncate and reload the accounts table from an accounts DataFrame; returns rows.
    ``truncate`` keeps the table definition (keys, grants) instead of dropping it."""
    props = {"truncate": "true", "batchsize": "10000", "numPartitions": str(partitions)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password

    def _write(d: DataFrame):
        d.write.mode("overwrite").options(**props).jdbc(url, check_table_name(table))

    return _observed_write(accounts.select(*ACCOUNT_FIELDS), "accounts_reloaded", _write)
