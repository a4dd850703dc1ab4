"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the shared tables of ``sf_dir`` whole (sessions from ``events``, accounts
from ``customer`` x ``nation``, CCU from ``events``) and derives everything else with Spark.
Queries that exercise writes (upserts, round trips, streams) write under
``spark.checkpoint.dir`` and return a DataFrame over what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import event_time_window
from pulsegrid.functions.timestamps import parse_event_time
from pulsegrid.operators import ccu as ccu_ops
from pulsegrid.operators import bitmaps, checks, cubes, metrics, quality
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.activity import attach_country, build_fact, build_fact_from_valid, grain_check, sessions_to_grain
from pulsegrid.operators.numbering import number_rows
from pulsegrid.operators.publish import changes, create_published_fact, publish_accounts, publish_load
from pulsegrid.operators.tables import export_fact_csv, read_fact_if_exists, upsert_fact, write_fact
from pulsegrid.config import Window
from pulsegrid.constants import CSV_DIALECT
from pulsegrid.plans import scenarios as S
from pulsegrid.plans.cube_build import build_cubes, follow_loads
from pulsegrid.plans.daily_activity import quality_report, run_summary
from pulsegrid.schemas import FACT_COLUMNS, FACT_SCHEMA, SESSION_FIELDS
from pulsegrid.session import prepare_session, scratch_path, stage
from pulsegrid.sources import fixtures, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs ----
# Lazy plans are memoised per (session, sf_dir): building one costs hundreds of JVM round
# trips on the driver. Only plans are kept; every query still scans and computes its data.
_PLANS: dict = {}


def _plan(spark: SparkSession, sf_dir: str, key: str, build) -> DataFrame:
    prepare_session(spark)
    k = (spark._jsparkSession.sessionUUID(), sf_dir, key)
    if k not in _PLANS:
        _PLANS[k] = build()
    return _PLANS[k]


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "sessions", lambda: fixtures.sessions_from_events(
        fixtures.table(spark, sf_dir, "events")))


def _accounts(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    return _plan(spark, sf_dir, f"accounts{snapshot}", lambda: fixtures.accounts_from_customers(
        fixtures.table(spark, sf_dir, "customer"), fixtures.table(spark, sf_dir, "nation"), snapshot=snapshot))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "fact", lambda: build_fact(_sessions(spark, sf_dir), _accounts(spark, sf_dir)))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "cube", lambda: cubes.build_cube(_fact(spark, sf_dir)))


def _staged_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube written once for this query; the KPI plans read it several times (range
    bounds, axis counts, slices), as they would read the cube table in production."""
    from pulsegrid.plans.cube_build import refresh_cube

    return refresh_cube(spark, _fact(spark, sf_dir), scratch_path(spark, "cube"))


def _windowed(sessions: DataFrame, window) -> DataFrame:
    """F2 over raw sessions: in-window or unparseable."""
    return sessions.where(
        event_time_window(parse_event_time("timestamp"), window.extract_start, window.extract_end)
    )


def _ccu(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    return fixtures.ccu_from_events(fixtures.table(spark, sf_dir, "events"))


# ---- DAU metrics ----

def dau_daily(spark, sf_dir):
    return metrics.dau_daily(_fact(spark, sf_dir))


def dau_daily_filtered(spark, sf_dir):
    return metrics.dau_daily(_fact(spark, sf_dir), S.FILTER_START, S.FILTER_END, S.FILTER_COUNTRY, S.FILTER_PLATFORM)


def dau_daily_platform_filtered(spark, sf_dir):
    return metrics.dau_daily(_fact(spark, sf_dir), S.FILTER_START, S.FILTER_END, None, S.FILTER_PLATFORM)


def dau_by_country(spark, sf_dir):
    return metrics.dau_by(_fact(spark, sf_dir), "country")


def dau_by_platform(spark, sf_dir):
    return metrics.dau_by(_fact(spark, sf_dir), "platform")


def dau_by_country_range(spark, sf_dir):
    return metrics.dau_by(_fact(spark, sf_dir), "country", S.FILTER_START, S.FILTER_END)


def dau_by_platform_range(spark, sf_dir):
    return metrics.dau_by(_fact(spark, sf_dir), "platform", S.FILTER_START, S.FILTER_END)


def dau_total(spark, sf_dir):
    return metrics.dau_total(_fact(spark, sf_dir))


def dau_avg_daily(spark, sf_dir):
    return metrics.dau_avg_daily(_fact(spark, sf_dir))


def dau_day_country(spark, sf_dir):
    return metrics.dau_by_day_and(_fact(spark, sf_dir), "country")


def dau_day_platform(spark, sf_dir):
    return metrics.dau_by_day_and(_fact(spark, sf_dir), "platform")


def dau_day_country_platform(spark, sf_dir):
    return metrics.dau_by_day_and(_fact(spark, sf_dir), "country", "platform")


def dau_cube(spark, sf_dir):
    return _cube(spark, sf_dir)


def dau_known_countries(spark, sf_dir):
    return metrics.dau_by(_fact(spark, sf_dir), "country", exclude_unknown=True)


def dau_unknown_users(spark, sf_dir):
    return metrics.unknown_users(_fact(spark, sf_dir))


def dau_last5_days(spark, sf_dir):
    return metrics.last_n_days(_fact(spark, sf_dir), 5)


def dau_top5_countries(spark, sf_dir):
    return metrics.top_n_countries(_fact(spark, sf_dir), 5)


# ---- fact, accounts, quality ----

def fact_daily_user_activity(spark, sf_dir):
    return _fact(spark, sf_dir)


def fact_grain_check(spark, sf_dir):
    return grain_check(_fact(spark, sf_dir))


def fact_data_checks(spark, sf_dir):
    """The checks read the fact three times; they read it from the fact written once."""
    return checks.fact_checks(stage(spark, _fact(spark, sf_dir), "fact"))


def dq_balance(spark, sf_dir):
    return checks.quality_balance(quality.classify_sessions(_sessions(spark, sf_dir)))


def accounts_one_per_user(spark, sf_dir):
    return latest_account_per_user(_accounts(spark, sf_dir))


def dq_classified_sessions(spark, sf_dir):
    return quality.classify_sessions(_sessions(spark, sf_dir)).select(*SESSION_FIELDS, "dq_reason")


def dq_counts(spark, sf_dir):
    return quality.quarantine_counts(quality.classify_sessions(_sessions(spark, sf_dir)))


def dq_totals(spark, sf_dir):
    return quality.quality_totals(quality.classify_sessions(_sessions(spark, sf_dir)))


def dq_quarantined_sessions(spark, sf_dir):
    return quality.quarantined_sessions(quality.classify_sessions(_sessions(spark, sf_dir)))


def sessions_staging_view(spark, sf_dir):
    view = quality.staging_view(_sessions(spark, sf_dir))
    view.createOrReplaceTempView("stg_sessions")  # K14: the staging view as a named view
    return spark.table("stg_sessions")


def sessions_strict_valid(spark, sf_dir):
    return quality.strict_valid_sessions(_sessions(spark, sf_dir))


def sessions_window_extract(spark, sf_dir):
    return _windowed(_sessions(spark, sf_dir), S.RUN_WINDOW)


def fact_reprocess_window(spark, sf_dir):
    return build_fact(_windowed(_sessions(spark, sf_dir), S.RUN_WINDOW), _accounts(spark, sf_dir))


def quality_report_query(spark, sf_dir):
    return quality_report(_sessions(spark, sf_dir), _accounts(spark, sf_dir))


def run_summary_query(spark, sf_dir):
    """Sessions are read once and staged classified; the fact, which the summary reads several
    times, is staged too."""
    classified = stage(spark, quality.classify_sessions(_sessions(spark, sf_dir)), "classified")
    accounts = _accounts(spark, sf_dir)
    fact = stage(spark, build_fact_from_valid(quality.valid_sessions(classified), accounts), "fact")
    return run_summary(quality_report(classified, accounts, fact), fact)


# ---- loads: window + upsert ----

def _two_loads(spark, sf_dir, mode: str) -> DataFrame:
    """Two overlapping runs into one table: FIRST_LOAD with accounts snapshot 1, then
    SECOND_LOAD (7-day look-back) with snapshot 2 where a quarter of users moved country."""
    path = scratch_path(spark, f"fact-{mode}")
    sessions = _sessions(spark, sf_dir)
    for window, snapshot in ((S.FIRST_LOAD, 1), (S.SECOND_LOAD, 2)):
        batch = build_fact(_windowed(sessions, window), _accounts(spark, sf_dir, snapshot))
        upsert_fact(spark, batch, path, mode=mode)
    return read_fact_if_exists(spark, path)


def fact_upsert_replace(spark, sf_dir):
    return _two_loads(spark, sf_dir, "replace")


def fact_merge_insert_only(spark, sf_dir):
    return _two_loads(spark, sf_dir, "insert_only")


def cube_incremental_refresh(spark, sf_dir):
    """E3 incrementally: after each of the two overlapping loads, refresh only that load's
    dates in the cube table. The result equals the cube of the final fact table."""
    from pulsegrid.plans.cube_build import refresh_cube

    fact_path, cube_path = scratch_path(spark, "fact-incr"), scratch_path(spark, "cube-incr")
    sessions = _sessions(spark, sf_dir)
    for window, snapshot in ((S.FIRST_LOAD, 1), (S.SECOND_LOAD, 2)):
        bounds = (window.extract_start, window.end_date)
        batch = build_fact(_windowed(sessions, window), _accounts(spark, sf_dir, snapshot))
        upsert_fact(spark, batch, fact_path, mode="replace")
        cube = refresh_cube(spark, read_fact_if_exists(spark, fact_path), cube_path, bounds)
    return cube


def fact_rerun_idempotent(spark, sf_dir):
    """The same full load twice into one table: the table equals one load."""
    path = scratch_path(spark, "fact-rerun")
    for _ in range(2):
        upsert_fact(spark, _fact(spark, sf_dir), path, mode="replace")
    return read_fact_if_exists(spark, path)


def fact_upsert_any_dates(spark, sf_dir):
    """A load of one window, then a batch that reaches far outside it on both sides, with the
    second accounts snapshot: no row of any date is lost."""
    path = scratch_path(spark, "fact-any")
    sessions = _sessions(spark, sf_dir)
    upsert_fact(spark, build_fact(_windowed(sessions, S.RUN_WINDOW), _accounts(spark, sf_dir)), path)
    upsert_fact(spark, build_fact(sessions, _accounts(spark, sf_dir, 2)), path)
    return read_fact_if_exists(spark, path)


def fact_empty_then_load(spark, sf_dir):
    """A window without valid sessions into a fresh table, then a normal load."""
    path = scratch_path(spark, "fact-empty")
    sessions = _sessions(spark, sf_dir)
    nothing = _windowed(sessions, Window(end_date="1999-12-31"))
    for batch in (nothing, sessions, nothing):
        upsert_fact(spark, build_fact(batch, _accounts(spark, sf_dir)), path)
    return read_fact_if_exists(spark, path)


def quarantine_two_runs(spark, sf_dir):
    """Two overlapping runs, the first of them run again, into one quarantine table: each
    run's rows stand once under its window."""
    path = scratch_path(spark, "quarantine-runs")
    for w in (S.FIRST_LOAD, S.SECOND_LOAD, S.FIRST_LOAD):
        rows = quality.quarantined_sessions(quality.classify_sessions(_windowed(_sessions(spark, sf_dir), w)))
        sinks.write_quarantine(rows, path, run=f"{w.extract_start}_{w.end_date}")
    return spark.read.parquet(path).select(*SESSION_FIELDS, "dq_reason", "run")


def sessions_json_policy(spark, sf_dir):
    """JSON lines with cut-off lines and quoted numbers, read and classified."""
    prepare_session(spark)
    path = scratch_path(spark, "session-lines")
    fixtures.session_lines_from_events(fixtures.table(spark, sf_dir, "events")).write.text(path)
    return quality.classify_sessions(readers.read_sessions_json(spark, path)).select(*SESSION_FIELDS, "dq_reason")


def session_records(spark, sf_dir):
    """The same documents as records of a message bus: parsed, written as records again, those parsed and classified.
    Malformed records come through raw."""
    prepare_session(spark)
    records = fixtures.session_lines_from_events(fixtures.table(spark, sf_dir, "events"))
    sent_on = stage(spark, sinks.session_records(readers.sessions_from_records(records)), "session-records")
    return quality.classify_sessions(readers.sessions_from_records(sent_on)).select(*SESSION_FIELDS, "dq_reason")


# ---- CCU ----

def ccu_hourly(spark, sf_dir):
    return ccu_ops.hourly_ccu(_ccu(spark, sf_dir))


def ccu_hourly_range(spark, sf_dir):
    return ccu_ops.hourly_ccu(_ccu(spark, sf_dir), *S.CCU_RANGE)


def ccu_peak(spark, sf_dir):
    return ccu_ops.ccu_peak(ccu_ops.hourly_ccu(_ccu(spark, sf_dir)))


def ccu_hourly_from_csv(spark, sf_dir):
    """S6 + K6: land the minute series as its CSV export, scan it back, aggregate, write the
    hourly CSV, read that back."""
    prepare_session(spark)
    out_path = scratch_path(spark, "ccu-hourly-csv")
    sinks.write_hourly_ccu_csv(ccu_ops.hourly_ccu(_ccu_csv(spark, sf_dir, dirty=False)), out_path)
    return spark.read.schema("hour timestamp_ntz, avg_ccu double").option("header", True).csv(out_path)


def _ccu_csv(spark, sf_dir, dirty):
    prepare_session(spark)
    path = scratch_path(spark, "ccu-csv")
    fixtures.raw_ccu_from_events(fixtures.table(spark, sf_dir, "events"), dirty).write.options(**CSV_DIALECT).csv(path)
    return readers.read_ccu_csv(spark, path)


def ccu_hourly_dirty_csv(spark, sf_dir):
    """Minutes without a usable time or value stay out of the means ..."""
    return ccu_ops.hourly_ccu(_ccu_csv(spark, sf_dir, dirty=True))


def ccu_reject_counts(spark, sf_dir):
    """... and are counted by reason."""
    return ccu_ops.ccu_rejects(_ccu_csv(spark, sf_dir, dirty=True))


# ---- cubes, axis, KPIs ----

def axis_meta(spark, sf_dir):
    return cubes.axis_meta(_fact(spark, sf_dir))


def cube_dense_country(spark, sf_dir):
    return cubes.dense_series(_staged_cube(spark, sf_dir), "country")


def cube_dense_platform(spark, sf_dir):
    return cubes.dense_series(_staged_cube(spark, sf_dir), "platform")


def country_allow_list(spark, sf_dir):
    return cubes.country_allow_list(_cube(spark, sf_dir), S.ALLOW_LIST)


def country_list_default(spark, sf_dir):
    return cubes.country_allow_list(_cube(spark, sf_dir))


def kpi_range(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_by_slice(cube, cubes.axis_range_all(cube))


def kpi_last_n(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_by_slice(cube, cubes.axis_range_last_n(cube, S.LAST_N_DAYS))


def kpi_custom_range(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_by_slice(cube, cubes.axis_range_custom(cube, S.CUSTOM_FROM, S.CUSTOM_TO))


def kpi_gap_range(spark, sf_dir):
    """a range that lies in a gap of the axis takes its two neighbours."""
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_by_slice(cube, cubes.axis_range_custom(cube, S.GAP, S.GAP))


def kpi_slice(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_of_slice(cube, cubes.axis_range_last_n(cube, S.LAST_N_DAYS), S.FILTER_COUNTRY, S.FILTER_PLATFORM)


def kpi_slice_never_seen(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.kpis_of_slice(cube, cubes.axis_range_custom(cube, S.CUSTOM_FROM, S.CUSTOM_TO), "NATION_99", "fridge")


def avg_dau_by_platform_in(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.avg_dau_by_platform_in(cube, cubes.axis_range_custom(cube, S.CUSTOM_FROM, S.CUSTOM_TO), S.FILTER_COUNTRY, S.PLATFORMS)


def cube_slice_series(spark, sf_dir):
    """Main chart for one country x platform slice over a custom range (F11 + F17 on the cube)."""
    cube = _staged_cube(spark, sf_dir)
    return cubes.slice_series(cube, cubes.axis_range_custom(cube, S.CUSTOM_FROM, S.CUSTOM_TO),
                              S.FILTER_COUNTRY, S.FILTER_PLATFORM)


def avg_dau_by_country(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.avg_dau_by_country(cube, cubes.axis_range_last_n(cube, S.LAST_N_DAYS))


def avg_dau_by_platform(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.avg_dau_by_platform(cube, cubes.axis_range_custom(cube, S.CUSTOM_FROM, S.CUSTOM_TO))


def avg_dau_by_country_allow_list(spark, sf_dir):
    cube = _staged_cube(spark, sf_dir)
    return cubes.avg_dau_by_country(cube, cubes.axis_range_all(cube), S.ALLOW_LIST)


def _cube_export(spark, sf_dir) -> str:
    """K7: the job's export of the cube, with totals and lists; returns its folder."""
    fact = stage(spark, _fact(spark, sf_dir), "fact")
    return build_cubes(spark, fact, countries=S.ALLOW_LIST, platforms=S.PLATFORMS).export_path


def cube_export_json(spark, sf_dir):
    """K7 round trip: export per-slice dense series as JSON, read back, and flatten to
    (level, country, platform, activity_date, dau) by position on the exported axis."""
    path = _cube_export(spark, sf_dir)
    axis = spark.read.schema("date string").json(f"{path}/axis").select(F.col("date").cast("date").alias("activity_date"))
    axis_arr = axis.agg(F.sort_array(F.collect_list("activity_date"))).scalar()
    series = spark.read.schema("level string, country string, platform string, series array<bigint>").json(f"{path}/series")
    return series.select(
        "level", "country", "platform", F.posexplode("series").alias("i", "dau")
    ).select("level", "country", "platform", F.element_at(axis_arr, F.col("i") + 1).alias("activity_date"), "dau")


def cube_export_totals(spark, sf_dir):
    return spark.read.schema("by string, name string, users long").json(f"{_cube_export(spark, sf_dir)}/totals")


def cube_export_lists(spark, sf_dir):
    return spark.read.schema("list string, name string, position int").json(f"{_cube_export(spark, sf_dir)}/lists")


# ---- sources and sinks round trips ----

def roundtrip_accounts_csv(spark, sf_dir):
    """K1 -> S1: land accounts as CSV, read back with the accounts scan."""
    path = scratch_path(spark, "accounts-csv")
    sinks.land_accounts_csv(_accounts(spark, sf_dir), path)
    return readers.read_accounts_csv(spark, path)


def roundtrip_accounts_csv_quoted(spark, sf_dir):
    """K1 -> S1 with quotes and commas in a field."""
    path = scratch_path(spark, "accounts-csv")
    sinks.land_accounts_csv(fixtures.quoted_accounts(_accounts(spark, sf_dir)), path)
    return readers.read_accounts_csv(spark, path)


def roundtrip_sessions_jsonl(spark, sf_dir):
    """K2 -> S4: land the run window's sessions as JSON lines, read back with the window."""
    path = scratch_path(spark, "sessions-jsonl")
    sinks.land_sessions_jsonl(_windowed(_sessions(spark, sf_dir), S.RUN_WINDOW), path)
    return readers.read_sessions_json(spark, path, S.RUN_WINDOW).select(*SESSION_FIELDS)


def roundtrip_typed_sessions(spark, sf_dir):
    """K13 -> S5/F3: land strictly valid typed sessions by event_date, range-scan the run
    window back (partition pruning + pushed timestamp filter)."""
    path = scratch_path(spark, "sessions-typed")
    sinks.land_typed_sessions(quality.strict_valid_sessions(_sessions(spark, sf_dir)), path)
    return readers.read_landed_sessions(spark, path, S.RUN_WINDOW)


def roundtrip_fact_parquet(spark, sf_dir):
    """K3 -> S7."""
    path = scratch_path(spark, "fact-parquet")
    write_fact(_fact(spark, sf_dir), path)
    return readers.read_fact(spark, path)


def roundtrip_fact_csv(spark, sf_dir):
    """K4: ordered CSV export, read back with the fact schema."""
    path = scratch_path(spark, "fact-csv")
    export_fact_csv(_fact(spark, sf_dir), path)
    return spark.read.schema(FACT_SCHEMA).options(**CSV_DIALECT).csv(path).select(*FACT_COLUMNS)


def roundtrip_quarantine(spark, sf_dir):
    """F7 as a table partitioned by reason, read back."""
    path = scratch_path(spark, "quarantine")
    sinks.write_quarantine(quality.quarantined_sessions(quality.classify_sessions(_sessions(spark, sf_dir))), path, run="all")
    return spark.read.parquet(path).select(*SESSION_FIELDS, "dq_reason")


def roundtrip_quality_report(spark, sf_dir):
    """K5: the quality report written as JSON and read back."""
    path = scratch_path(spark, "dq-report")
    sinks.write_quality_report(quality_report(_sessions(spark, sf_dir), _accounts(spark, sf_dir)), path)
    return spark.read.json(path).select(*quality_report_columns())


def quality_report_columns() -> list[str]:
    from pulsegrid.schemas import DQ_REASONS

    return ["accounts_loaded", "sessions_loaded", "sessions_valid", "sessions_quarantined",
            *[f"q_{r}" for r in DQ_REASONS], "fact_rows", "distinct_users"]


# ---- streaming ----

def _run_fact_stream(spark, sf_dir) -> tuple[DataFrame, str]:
    """The landed sessions, one file a day, through several micro-batches in the order the
    files happened to be written."""
    from pulsegrid.streaming.fact_stream import run_fact_stream

    prepare_session(spark)
    landing, quarantine = scratch_path(spark, "stream-sessions"), scratch_path(spark, "stream-quarantine")
    sinks.land_sessions_jsonl(_sessions(spark, sf_dir), landing)
    fact = run_fact_stream(spark, landing, _accounts(spark, sf_dir), quarantine_path=quarantine,
                           max_files_per_trigger=S.STREAM_FILES)
    return fact, quarantine


def stream_fact(spark, sf_dir):
    return _run_fact_stream(spark, sf_dir)[0]


def stream_quarantine(spark, sf_dir):
    """What the stream set aside, over all micro-batches."""
    return spark.read.parquet(_run_fact_stream(spark, sf_dir)[1]).select(*SESSION_FIELDS, "dq_reason")


def stream_ccu_hourly(spark, sf_dir):
    from pulsegrid.streaming.ccu_stream import run_ccu_stream

    prepare_session(spark)
    landing = scratch_path(spark, "stream-ccu")
    # Ten files, each with minutes of every day.
    fixtures.raw_ccu_from_events(fixtures.table(spark, sf_dir, "events")).repartition(10, "ccu") \
        .write.options(**CSV_DIALECT).csv(landing)
    return run_ccu_stream(spark, landing, max_files_per_trigger=4)


def stream_dau(spark, sf_dir):
    from pulsegrid.streaming.dau_stream import run_dau_stream

    prepare_session(spark)
    landing = scratch_path(spark, "stream-dau")
    sinks.land_sessions_jsonl(_sessions(spark, sf_dir), landing)
    return run_dau_stream(spark, landing, max_files_per_trigger=S.STREAM_FILES)


# ---- loads through the catalog: checked publish, change feed, bitmaps ----

def _published_table(spark) -> str:
    """A fact table of its own in the catalog."""
    import uuid

    prepare_session(spark)
    table = f"fact_{uuid.uuid4().hex[:12]}"
    create_published_fact(spark, table, scratch_path(spark, "published"))
    return table


def _publish_two_loads(spark, sf_dir, mode: str) -> str:
    table = _published_table(spark)
    for window, snapshot in ((S.FIRST_LOAD, 1), (S.SECOND_LOAD, 2)):
        publish_load(spark, build_fact(_windowed(_sessions(spark, sf_dir), window), _accounts(spark, sf_dir, snapshot)), table, mode)
    return table


def fact_publish_checked(spark, sf_dir):
    """K9: the two overlapping loads written beside the table, audited, published, and read through the catalog."""
    return spark.table(_publish_two_loads(spark, sf_dir, "replace")).select(*FACT_COLUMNS)


def fact_publish_insert_only(spark, sf_dir):
    """K10 through the catalog."""
    return spark.table(_publish_two_loads(spark, sf_dir, "insert_only")).select(*FACT_COLUMNS)


def fact_clustered_loads(spark, sf_dir):
    """K8: the two loads into a fact clustered by user, each joined to accounts clustered alike, read through the catalog."""
    import uuid

    prepare_session(spark)
    accounts, base, table = f"accounts_{uuid.uuid4().hex[:12]}", scratch_path(spark, "clustered"), f"fact_{uuid.uuid4().hex[:12]}"
    create_published_fact(spark, table, f"{base}/fact", S.BUCKETS)
    for window, snapshot in ((S.FIRST_LOAD, 1), (S.SECOND_LOAD, 2)):
        publish_accounts(spark, _accounts(spark, sf_dir, snapshot), accounts, base, S.BUCKETS)
        valid = quality.valid_sessions(quality.classify_sessions(_windowed(_sessions(spark, sf_dir), window)))
        publish_load(spark, attach_country(sessions_to_grain(valid), spark.table(accounts)), table)
    return spark.table(table).select(*FACT_COLUMNS)


def _follow_scattered(spark, sf_dir):
    """A load of a window, then one of days scattered inside and outside it with the second accounts snapshot; cube,
    bitmaps and export follow each load's changed days."""
    table, base = _published_table(spark), scratch_path(spark, "followed")
    sessions = _sessions(spark, sf_dir)
    first = build_fact(_windowed(sessions, S.FIRST_LOAD), _accounts(spark, sf_dir))
    second = build_fact(sessions, _accounts(spark, sf_dir, 2)).where(F.col("activity_date").isin(S.SCATTERED))
    for batch in (first, second):
        publish_load(spark, batch, table)
        out = follow_loads(spark, table, base, S.ALLOW_LIST, S.PLATFORMS)
    return table, out


def change_feed(spark, sf_dir):
    """The days that each of the two loads changed, with their rows before and after; loads numbered in order."""
    table, _ = _follow_scattered(spark, sf_dir)
    feed = changes(spark, table)
    numbered = number_rows(feed.select("load").distinct(), ["load"], name="load_number")
    return feed.join(numbered, "load").select(F.col("load_number").cast("int").alias("load_number"), "activity_date", "rows_before", "rows_after")


def cube_follow_changes(spark, sf_dir):
    """The cube after loads of scattered days equals the cube of the final fact."""
    return _follow_scattered(spark, sf_dir)[1].cube


def export_follow_totals(spark, sf_dir):
    """The exported totals, from the bitmaps."""
    return spark.read.schema("by string, name string, users long").json(f"{_follow_scattered(spark, sf_dir)[1].export_path}/totals")


def export_follow_meta(spark, sf_dir):
    """A17 from the cube's axis and the bitmaps."""
    return spark.read.schema("min_date date, max_date date, n_days long, span_years double, total_users long, unknown_users long").json(
        f"{_follow_scattered(spark, sf_dir)[1].export_path}/meta")


def _bitmaps(spark, sf_dir) -> DataFrame:
    return bitmaps.refresh_bitmaps(spark, stage(spark, _fact(spark, sf_dir), "fact"), scratch_path(spark, "bitmaps"))


def bitmap_users_total(spark, sf_dir):
    """A4 from daily bitmaps: over all days, over a range, and there by country, platform and both."""
    b = _bitmaps(spark, sf_dir)
    asked = {"all": (), "range": (S.FILTER_START, S.FILTER_END), "country": (S.FILTER_START, S.FILTER_END, S.FILTER_COUNTRY),
             "platform": (S.FILTER_START, S.FILTER_END, None, S.FILTER_PLATFORM),
             "both": (S.FILTER_START, S.FILTER_END, S.FILTER_COUNTRY, S.FILTER_PLATFORM)}
    rows = [bitmaps.distinct_users(b, *args).select(F.lit(name).alias("asked"), "distinct_users") for name, args in asked.items()]
    return reduce(DataFrame.unionByName, rows)


def bitmap_by_country_range(spark, sf_dir):
    return bitmaps.users_by(_bitmaps(spark, sf_dir), "country", S.FILTER_START, S.FILTER_END)


def bitmap_by_platform_range(spark, sf_dir):
    return bitmaps.users_by(_bitmaps(spark, sf_dir), "platform", S.FILTER_START, S.FILTER_END)


def bitmap_known_countries(spark, sf_dir):
    return bitmaps.users_by(_bitmaps(spark, sf_dir), "country", exclude_unknown=True)


def stream_fact_state(spark, sf_dir):
    """T2 with bounded state, in several micro-batches, in the order the files were written."""
    from pulsegrid.streaming.fact_state import run_fact_state_stream

    prepare_session(spark)
    landing = scratch_path(spark, "state-sessions")
    sinks.land_sessions_jsonl(_sessions(spark, sf_dir), landing)
    return run_fact_state_stream(spark, landing, _accounts(spark, sf_dir), scratch_path(spark, "state-fact"),
                                 max_files_per_trigger=S.STREAM_FILES)


def stream_fact_published(spark, sf_dir):
    """T2 into the catalog: two waves, each in micro-batches of a few files, published when a wave is done."""
    from pulsegrid.streaming.fact_state import run_fact_state_stream

    table, landing, base = _published_table(spark), scratch_path(spark, "state-sessions"), scratch_path(spark, "state-fact")
    sessions = _sessions(spark, sf_dir).withColumn("day", parse_event_time("timestamp").cast("date"))
    for land in _in_waves(spark, sessions, "day", lambda rows: rows.select(*SESSION_FIELDS).write.mode("append").json(landing)):
        land()
        run_fact_state_stream(spark, landing, _accounts(spark, sf_dir), base, max_files_per_trigger=2, table=table)
    return spark.table(table).select(*FACT_COLUMNS)


def _in_waves(spark, rows: DataFrame, time: str, write) -> list:
    """What happened in the days of the first wave lands first, all the rest after it."""
    first = F.coalesce(F.col(time).between(F.lit(S.FIRST_WAVE[0]), F.lit(S.FIRST_WAVE[1])), F.lit(False))
    return [lambda: write(rows.where(first)), lambda: write(rows.where(~first))]


def stream_fact_late(spark, sf_dir):
    """Sessions that come later than the look-back, by day; they are in the fact all the same."""
    from pulsegrid.streaming.fact_state import late_sessions, run_fact_state_stream

    prepare_session(spark)
    landing, base = scratch_path(spark, "state-sessions"), scratch_path(spark, "state-fact")
    sessions = _sessions(spark, sf_dir).withColumn("day", parse_event_time("timestamp").cast("date"))
    for land in _in_waves(spark, sessions, "day", lambda rows: rows.select(*SESSION_FIELDS).write.mode("append").json(landing)):
        land()
        run_fact_state_stream(spark, landing, _accounts(spark, sf_dir), base, look_back=S.STREAM_LOOK_BACK)
    return late_sessions(spark, base)


def stream_ccu_event_time(spark, sf_dir):
    """T3 in event time: ten files, each with minutes of every day, so most come late."""
    from pulsegrid.streaming.ccu_hours import run_ccu_hours_stream

    prepare_session(spark)
    landing = scratch_path(spark, "hours-ccu")
    fixtures.raw_ccu_from_events(fixtures.table(spark, sf_dir, "events")).repartition(10, "ccu") \
        .write.options(**CSV_DIALECT).csv(landing)
    return run_ccu_hours_stream(spark, landing, scratch_path(spark, "hours"), max_files_per_trigger=4)


def stream_ccu_corrections(spark, sf_dir):
    """Every hour with its mean, its minutes, and how many of them came late."""
    from pulsegrid.streaming.ccu_hours import hour_states, run_ccu_hours_stream

    prepare_session(spark)
    landing, base = scratch_path(spark, "hours-ccu"), scratch_path(spark, "hours")
    raw = fixtures.raw_ccu_from_events(fixtures.table(spark, sf_dir, "events"), dirty=True).withColumn(
        "day", parse_event_time("timestamp").cast("date"))
    for land in _in_waves(spark, raw, "day", lambda rows: rows.drop("day").write.mode("append").options(**CSV_DIALECT).csv(landing)):
        land()
        run_ccu_hours_stream(spark, landing, base)
    return hour_states(spark, base).drop("is_open")


def stream_dau_preview(spark, sf_dir):
    """T4: DAU of every day and slice with the preview beside it: whether that is within 5 % of it, three standard errors."""
    from pulsegrid.streaming.dau_preview import run_dau_preview_stream

    prepare_session(spark)
    landing = scratch_path(spark, "preview-sessions")
    sinks.land_sessions_jsonl(_sessions(spark, sf_dir), landing)
    preview = run_dau_preview_stream(spark, landing, _accounts(spark, sf_dir), scratch_path(spark, "preview"), S.STREAM_FILES)
    level = {"all": cubes.LEVEL_DAY, "country": cubes.LEVEL_DAY_COUNTRY, "platform": cubes.LEVEL_DAY_PLATFORM,
             "country_platform": cubes.LEVEL_DAY_COUNTRY_PLATFORM}
    named = preview.replace(level, subset=["level"]).withColumnsRenamed({c: f"_{c}" for c in ("activity_date", "level", "country", "platform")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("activity_date", "level", "country", "platform")]
    return _cube(spark, sf_dir).join(named, same, "full").select(
        "activity_date", "level", "country", "platform", "dau", (F.abs(F.col("dau_preview") - F.col("dau")) <= F.col("dau") * 0.05).alias("close"))


QUERIES: dict[str, Query] = {
    "dau_daily": dau_daily,
    "dau_daily_filtered": dau_daily_filtered,
    "dau_daily_platform_filtered": dau_daily_platform_filtered,
    "dau_by_country": dau_by_country,
    "dau_by_platform": dau_by_platform,
    "dau_by_country_range": dau_by_country_range,
    "dau_by_platform_range": dau_by_platform_range,
    "dau_total": dau_total,
    "dau_avg_daily": dau_avg_daily,
    "dau_day_country": dau_day_country,
    "dau_day_platform": dau_day_platform,
    "dau_day_country_platform": dau_day_country_platform,
    "dau_cube": dau_cube,
    "dau_known_countries": dau_known_countries,
    "dau_unknown_users": dau_unknown_users,
    "dau_last5_days": dau_last5_days,
    "dau_top5_countries": dau_top5_countries,
    "fact_daily_user_activity": fact_daily_user_activity,
    "fact_grain_check": fact_grain_check,
    "fact_data_checks": fact_data_checks,
    "dq_balance": dq_balance,
    "accounts_one_per_user": accounts_one_per_user,
    "dq_classified_sessions": dq_classified_sessions,
    "dq_counts": dq_counts,
    "dq_totals": dq_totals,
    "dq_quarantined_sessions": dq_quarantined_sessions,
    "sessions_staging_view": sessions_staging_view,
    "sessions_strict_valid": sessions_strict_valid,
    "sessions_window_extract": sessions_window_extract,
    "fact_reprocess_window": fact_reprocess_window,
    "fact_upsert_replace": fact_upsert_replace,
    "fact_merge_insert_only": fact_merge_insert_only,
    "fact_rerun_idempotent": fact_rerun_idempotent,
    "cube_incremental_refresh": cube_incremental_refresh,
    "ccu_hourly": ccu_hourly,
    "ccu_hourly_range": ccu_hourly_range,
    "ccu_peak": ccu_peak,
    "ccu_hourly_from_csv": ccu_hourly_from_csv,
    "axis_meta": axis_meta,
    "cube_dense_country": cube_dense_country,
    "cube_dense_platform": cube_dense_platform,
    "cube_export_json": cube_export_json,
    "country_allow_list": country_allow_list,
    "country_list_default": country_list_default,
    "cube_slice_series": cube_slice_series,
    "kpi_range": kpi_range,
    "kpi_last_n": kpi_last_n,
    "kpi_custom_range": kpi_custom_range,
    "avg_dau_by_country": avg_dau_by_country,
    "avg_dau_by_platform": avg_dau_by_platform,
    "avg_dau_by_country_allow_list": avg_dau_by_country_allow_list,
    "roundtrip_accounts_csv": roundtrip_accounts_csv,
    "roundtrip_sessions_jsonl": roundtrip_sessions_jsonl,
    "roundtrip_typed_sessions": roundtrip_typed_sessions,
    "roundtrip_fact_parquet": roundtrip_fact_parquet,
    "roundtrip_fact_csv": roundtrip_fact_csv,
    "roundtrip_quarantine": roundtrip_quarantine,
    "roundtrip_quality_report": roundtrip_quality_report,
    "quality_report": quality_report_query,
    "run_summary": run_summary_query,
    "stream_fact": stream_fact,
    "stream_ccu_hourly": stream_ccu_hourly,
    "stream_dau": stream_dau,
    "fact_publish_checked": fact_publish_checked,
    "fact_publish_insert_only": fact_publish_insert_only,
    "fact_clustered_loads": fact_clustered_loads,
    "change_feed": change_feed,
    "cube_follow_changes": cube_follow_changes,
    "export_follow_totals": export_follow_totals,
    "export_follow_meta": export_follow_meta,
    "bitmap_users_total": bitmap_users_total,
    "bitmap_by_country_range": bitmap_by_country_range,
    "bitmap_by_platform_range": bitmap_by_platform_range,
    "bitmap_known_countries": bitmap_known_countries,
    "stream_fact_state": stream_fact_state,
    "stream_fact_published": stream_fact_published,
    "stream_fact_late": stream_fact_late,
    "stream_dau_preview": stream_dau_preview,
    "stream_ccu_event_time": stream_ccu_event_time,
    "stream_ccu_corrections": stream_ccu_corrections,
    "sessions_json_policy": sessions_json_policy,
    "session_records": session_records,
    "ccu_hourly_dirty_csv": ccu_hourly_dirty_csv,
    "ccu_reject_counts": ccu_reject_counts,
    "roundtrip_accounts_csv_quoted": roundtrip_accounts_csv_quoted,
    "quarantine_two_runs": quarantine_two_runs,
    "fact_upsert_any_dates": fact_upsert_any_dates,
    "fact_empty_then_load": fact_empty_then_load,
    "stream_quarantine": stream_quarantine,
    "kpi_gap_range": kpi_gap_range,
    "kpi_slice": kpi_slice,
    "kpi_slice_never_seen": kpi_slice_never_seen,
    "avg_dau_by_platform_in": avg_dau_by_platform_in,
    "cube_export_totals": cube_export_totals,
    "cube_export_lists": cube_export_lists,
}
