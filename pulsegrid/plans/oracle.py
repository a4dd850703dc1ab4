"""Independent SQL statement of every registered query, for DuckDB over the shared tables.

Written from the semantics, not from the Spark plans: windows use ROW_NUMBER where the Spark
side aggregates, grouping levels are separate GROUP BYs, and so on. Column names match the
Spark outputs exactly.
"""

from __future__ import annotations

from datetime import date, datetime

from pulsegrid.config import Window
from pulsegrid.constants import CCU_LATENESS_HOURS
from pulsegrid.plans import scenarios as S
from pulsegrid.schemas import DQ_REASONS
from pulsegrid.sources import fixtures as FX


def _d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"


def _ts(x: date | datetime) -> str:
    if not isinstance(x, datetime):
        x = datetime(x.year, x.month, x.day)
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


SESSIONS_CTE = f"""
moved AS (SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) = DATE '{FX.GAP_DAY}' THEN ts + INTERVAL 1 DAY ELSE ts END AS ts) FROM events),
sessions_base AS (
  SELECT event_id,
    CASE WHEN event_id % {FX.NULL_USER_EVERY} = 0 THEN NULL WHEN event_id % {FX.BLANK_USER_EVERY} = 0 THEN ''
         ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % {FX.NULL_TIMESTAMP_EVERY} = 0 THEN NULL
         WHEN event_id % {FX.BAD_TIMESTAMP_EVERY} = 0 THEN '{FX.BAD_TIMESTAMP_TEXT}'
         WHEN event_id % {FX.SPACE_TIMESTAMP_EVERY} = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS "timestamp",
    CAST(CASE WHEN event_id % {FX.NULL_DURATION_EVERY} = 0 THEN NULL
              WHEN event_id % {FX.NEGATIVE_DURATION_EVERY} = 0 THEN -value ELSE value END AS DOUBLE) AS duration,
    CASE WHEN event_id % {FX.BLANK_PLATFORM_EVERY} = 0 THEN '{FX.BLANK_PLATFORM_TEXT}'
         WHEN event_id % {FX.NULL_PLATFORM_EVERY} = 0 THEN NULL ELSE event_type END AS platform
  FROM moved),
sessions_raw AS (
  SELECT user_id, "timestamp", duration, platform FROM sessions_base
  UNION ALL
  SELECT user_id, "timestamp", duration, platform FROM sessions_base WHERE event_id % {FX.DUPLICATE_EVERY} = 0)"""

# What each rule finds wrong with a row; the first that applies is the row's reason.
_FAULTS = {
    "null_user_id": "coalesce(trim(user_id), '') = ''",
    "null_timestamp": '"timestamp" IS NULL',
    "invalid_timestamp": 'TRY_CAST("timestamp" AS TIMESTAMP) IS NULL',
    "null_platform": "coalesce(trim(platform), '') = ''",
    "negative_duration": "coalesce(duration, 0) < 0",
}


def classified_cte(name: str = "classified", source: str = "sessions_raw") -> str:
    faults = ", ".join(f"IF({fault}, '{reason}', NULL)" for reason, fault in _FAULTS.items())
    return f"""
{name} AS (
  SELECT user_id, "timestamp", duration, platform, TRY_CAST("timestamp" AS TIMESTAMP) AS ts, COALESCE({faults}) AS dq_reason
  FROM {source})"""


def accounts_cte(suffix: str = "", snapshot: int = 1) -> str:
    parts = [
        f"SELECT c_custkey, c_nationkey, 0 AS shift, '{FX.ACCOUNT_UPDATED_AT}' AS updated_at, "
        f"(c_custkey % {FX.NULL_COUNTRY_EVERY} = 0) AS null_country FROM customer",
        f"SELECT c_custkey, c_nationkey, 1, '{FX.NEWER_UPDATED_AT}', false FROM customer "
        f"WHERE c_custkey % {FX.NEWER_ACCOUNT_EVERY} = 0",
        f"SELECT c_custkey, c_nationkey, 2, '{FX.ACCOUNT_UPDATED_AT}', false FROM customer "
        f"WHERE c_custkey % {FX.TIED_ACCOUNT_EVERY} = 0",
    ]
    if snapshot >= 2:
        parts.append(
            f"SELECT c_custkey, c_nationkey, 3, '{FX.MOVED_UPDATED_AT}', false FROM customer "
            f"WHERE c_custkey % {FX.MOVED_ACCOUNT_EVERY} = 1"
        )
    union = "\n  UNION ALL ".join(parts)
    return f"""
account_variants{suffix} AS (
  {union}),
accounts_raw{suffix} AS (
  SELECT CASE WHEN v.c_custkey % {FX.NO_ACCOUNT_EVERY} = 0 THEN CAST(v.c_custkey AS VARCHAR) || '{FX.CLOSED_ACCOUNT_SUFFIX}'
              ELSE CAST(v.c_custkey AS VARCHAR) END AS user_id,
         CASE WHEN v.null_country THEN NULL ELSE n.n_name END AS country,
         '{FX.ACCOUNT_CREATED_AT}' AS created_at, v.updated_at
  FROM account_variants{suffix} v LEFT JOIN nation n ON n.n_nationkey = (v.c_nationkey + v.shift) % {FX.NATION_COUNT}),
accounts_one{suffix} AS (
  SELECT user_id, country, created_at, updated_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
        ORDER BY TRY_CAST(updated_at AS TIMESTAMP) DESC NULLS LAST, country ASC NULLS LAST) AS rn
    FROM accounts_raw{suffix} WHERE user_id IS NOT NULL) WHERE rn = 1)"""


def fact_cte(name: str = "fact", classified: str = "classified", accounts: str = "accounts_one") -> str:
    return f"""
{name} AS (
  SELECT g.activity_date, g.user_id, COALESCE(a.country, 'UNKNOWN') AS country, g.platform
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS activity_date, user_id, platform
        FROM {classified} WHERE dq_reason IS NULL) g
  LEFT JOIN {accounts} a ON a.user_id = g.user_id)"""


def window_cte(name: str, window: Window, source: str = "sessions_raw") -> str:
    return f"""
{name} AS (
  SELECT * FROM {source}
  WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NULL
     OR (TRY_CAST("timestamp" AS TIMESTAMP) >= {_ts(window.extract_start)}
         AND TRY_CAST("timestamp" AS TIMESTAMP) < {_ts(window.extract_end)}))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_ctes(SESSIONS_CTE, classified_cte(), accounts_cte(), fact_cte())

CUBE_CTE = """
cube AS (
  SELECT activity_date, 'day' AS level, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS platform,
         COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY activity_date
  UNION ALL
  SELECT activity_date, 'day_country', country, NULL, COUNT(DISTINCT user_id) FROM fact GROUP BY activity_date, country
  UNION ALL
  SELECT activity_date, 'day_platform', NULL, platform, COUNT(DISTINCT user_id) FROM fact GROUP BY activity_date, platform
  UNION ALL
  SELECT activity_date, 'day_country_platform', country, platform, COUNT(DISTINCT user_id)
  FROM fact GROUP BY activity_date, country, platform),
axis AS (SELECT DISTINCT activity_date FROM fact)"""

CUBE_BASE = with_ctes(SESSIONS_CTE, classified_cte(), accounts_cte(), fact_cte(), CUBE_CTE)


def _range_all() -> str:
    return "bounds AS (SELECT MIN(activity_date) AS lo, MAX(activity_date) AS hi FROM axis)"


def _range_last_n(n: int) -> str:
    return (f"bounds AS (SELECT MIN(activity_date) AS lo, MAX(activity_date) AS hi FROM "
            f"(SELECT activity_date FROM axis ORDER BY activity_date DESC LIMIT {int(n)}))")


def _range_custom(lo: date, hi: date) -> str:
    return f"""snapped AS (
  SELECT COALESCE(MIN(activity_date) FILTER (WHERE activity_date >= {_d(lo)}), MIN(activity_date)) AS lo0,
         COALESCE(MAX(activity_date) FILTER (WHERE activity_date <= {_d(hi)}), MAX(activity_date)) AS hi0
  FROM axis),
bounds AS (SELECT LEAST(lo0, hi0) AS lo, GREATEST(lo0, hi0) AS hi FROM snapped)"""


def _kpi_sql(bounds_cte: str) -> str:
    return CUBE_BASE.rstrip() + f""",
{bounds_cte},
nd AS (SELECT COUNT(*) AS n_days FROM axis, bounds WHERE activity_date BETWEEN lo AND hi),
slices AS (SELECT DISTINCT level, country, platform FROM cube),
inr AS (SELECT c.* FROM cube c, bounds b WHERE c.activity_date BETWEEN b.lo AND b.hi),
agg AS (
  SELECT level, country, platform, SUM(dau) AS s, MAX(dau) AS peak FROM inr GROUP BY level, country, platform),
pk AS (
  SELECT i.level, i.country, i.platform, MAX(i.activity_date) AS peak_date
  FROM inr i JOIN agg a ON i.level = a.level AND i.country IS NOT DISTINCT FROM a.country
       AND i.platform IS NOT DISTINCT FROM a.platform AND i.dau = a.peak
  GROUP BY i.level, i.country, i.platform)
SELECT s.level, s.country, s.platform, b.lo AS range_start, b.hi AS range_end, nd.n_days,
       CAST(COALESCE(a.s, 0) AS DOUBLE) / CAST(nd.n_days AS DOUBLE) AS avg_dau,
       CAST(COALESCE(a.peak, 0) AS BIGINT) AS peak_dau,
       COALESCE(pk.peak_date, b.hi) AS peak_date,
       CAST(COALESCE(a.s, 0) AS BIGINT) AS player_days
FROM slices s CROSS JOIN bounds b CROSS JOIN nd
LEFT JOIN agg a ON a.level = s.level AND a.country IS NOT DISTINCT FROM s.country AND a.platform IS NOT DISTINCT FROM s.platform
LEFT JOIN pk ON pk.level = s.level AND pk.country IS NOT DISTINCT FROM s.country AND pk.platform IS NOT DISTINCT FROM s.platform
"""


def _avg_by_country_sql(bounds_cte: str, allow: list[str] | None = None) -> str:
    allow_sql = ""
    if allow:
        allow_sql = " AND c.country IN (" + ", ".join(f"'{x}'" for x in allow) + ")"
    return CUBE_BASE.rstrip() + f""",
{bounds_cte},
nd AS (SELECT COUNT(*) AS n_days FROM axis, bounds WHERE activity_date BETWEEN lo AND hi)
SELECT c.platform AS platform_filter, c.country,
       CAST(SUM(c.dau) AS DOUBLE) / CAST(MAX(nd.n_days) AS DOUBLE) AS avg_dau
FROM cube c, bounds b, nd
WHERE c.level IN ('day_country', 'day_country_platform') AND c.country <> 'UNKNOWN'
  AND c.activity_date BETWEEN b.lo AND b.hi{allow_sql}
GROUP BY c.platform, c.country
HAVING SUM(c.dau) > 0
"""


def _avg_by_platform_sql(bounds_cte: str) -> str:
    return CUBE_BASE.rstrip() + f""",
{bounds_cte},
nd AS (SELECT COUNT(*) AS n_days FROM axis, bounds WHERE activity_date BETWEEN lo AND hi)
SELECT c.country AS country_filter, c.platform, CAST(SUM(c.dau) AS DOUBLE) / CAST(MAX(nd.n_days) AS DOUBLE) AS avg_dau
FROM cube c, bounds b, nd
WHERE c.level IN ('day_platform', 'day_country_platform') AND c.activity_date BETWEEN b.lo AND b.hi
  AND c.country IS DISTINCT FROM 'UNKNOWN'
GROUP BY c.country, c.platform
"""


def _avg_by_platform_in_sql(bounds_cte: str, country: str, platforms: list[str]) -> str:
    listed = ", ".join(f"('{p}', {i + 1})" for i, p in enumerate(platforms))
    return CUBE_BASE.rstrip() + f""",
{bounds_cte},
listed(platform, position) AS (VALUES {listed}),
days AS (SELECT a.activity_date FROM axis a, bounds WHERE a.activity_date BETWEEN lo AND hi),
counted AS (SELECT platform, COUNT(DISTINCT (activity_date, user_id)) AS s FROM fact JOIN days USING (activity_date)
            WHERE country = '{country}' GROUP BY platform)
SELECT l.platform, CAST(l.position AS INTEGER) AS position,
       CAST(COALESCE(c.s, 0) AS DOUBLE) / CAST((SELECT COUNT(*) FROM days) AS DOUBLE) AS avg_dau
FROM listed l LEFT JOIN counted c USING (platform)
"""


def _kpi_slice_sql(bounds_cte: str, country: str, platform: str) -> str:
    return CUBE_BASE.rstrip() + f""",
{bounds_cte},
series AS (SELECT a.activity_date, COUNT(DISTINCT f.user_id) AS dau FROM axis a CROSS JOIN bounds b
  LEFT JOIN fact f ON f.activity_date = a.activity_date AND f.country = '{country}' AND f.platform = '{platform}'
  WHERE a.activity_date BETWEEN b.lo AND b.hi GROUP BY 1)
SELECT '{country}' AS country, '{platform}' AS platform, lo AS range_start, hi AS range_end, COUNT(*) AS n_days,
       AVG(dau) AS avg_dau, MAX(dau) AS peak_dau, arg_max(activity_date, (dau, activity_date)) AS peak_date,
       CAST(SUM(dau) AS BIGINT) AS player_days
FROM series, bounds GROUP BY lo, hi
"""


def _dense_sql(by: str) -> str:
    level = "day_country" if by == "country" else "day_platform"
    return CUBE_BASE.rstrip() + f""",
grp AS (SELECT DISTINCT {by} FROM cube WHERE level = '{level}')
SELECT g.{by}, a.activity_date, CAST(COALESCE(c.dau, 0) AS BIGINT) AS dau
FROM grp g CROSS JOIN axis a
LEFT JOIN cube c ON c.level = '{level}' AND c.{by} = g.{by} AND c.activity_date = a.activity_date
"""


def _two_loads_ctes(mode: str) -> list[str]:
    """CTEs ending in ``fact``: the table after FIRST_LOAD then SECOND_LOAD in ``mode``."""
    w1, w2 = S.FIRST_LOAD, S.SECOND_LOAD
    ctes = [
        SESSIONS_CTE,
        accounts_cte("_s1", 1),
        accounts_cte("_s2", 2),
        window_cte("win1", w1),
        window_cte("win2", w2),
        classified_cte("classified1", "win1"),
        classified_cte("classified2", "win2"),
        fact_cte("batch1", "classified1", "accounts_one_s1"),
        fact_cte("batch2", "classified2", "accounts_one_s2"),
    ]
    winners, losers = ("batch2", "batch1") if mode == "replace" else ("batch1", "batch2")
    ctes.append(f"""
fact AS (
  SELECT * FROM {winners}
  UNION ALL
  SELECT * FROM {losers} l WHERE NOT EXISTS (
    SELECT 1 FROM {winners} w
    WHERE w.activity_date = l.activity_date AND w.user_id = l.user_id AND w.platform = l.platform))""")
    return ctes


def _two_loads_sql(mode: str) -> str:
    return with_ctes(*_two_loads_ctes(mode)) + "SELECT activity_date, user_id, country, platform FROM fact\n"


_SCATTERED = "activity_date IN (" + ", ".join(_d(d) for d in S.SCATTERED) + ")"
# The table after FIRST_LOAD and a batch of scattered days with the second snapshot.
_SCATTERED_CTES = [
    SESSIONS_CTE, accounts_cte("_s1", 1), accounts_cte("_s2", 2), classified_cte(), window_cte("win1", S.FIRST_LOAD),
    classified_cte("classified1", "win1"), fact_cte("batch1", "classified1", "accounts_one_s1"), fact_cte("every_day", "classified", "accounts_one_s2"),
    f"""
fact AS (SELECT * FROM every_day WHERE {_SCATTERED} UNION ALL SELECT * FROM batch1 WHERE NOT ({_SCATTERED}))"""]

FACT_SQL = BASE + "SELECT activity_date, user_id, country, platform FROM fact\n"

_Q_COLS = ", ".join(f"COUNT(*) FILTER (WHERE dq_reason = '{r}') AS q_{r}" for r in DQ_REASONS)

QUALITY_REPORT_SQL = BASE + f"""
SELECT (SELECT COUNT(*) FROM accounts_raw) AS accounts_loaded,
       COUNT(*) AS sessions_loaded,
       COUNT(*) FILTER (WHERE dq_reason IS NULL) AS sessions_valid,
       COUNT(*) FILTER (WHERE dq_reason IS NOT NULL) AS sessions_quarantined,
       {_Q_COLS},
       (SELECT COUNT(*) FROM fact) AS fact_rows,
       (SELECT COUNT(DISTINCT user_id) FROM fact) AS distinct_users
FROM classified
"""

RUN_SUMMARY_SQL = BASE.rstrip() + f""",
report AS (
  SELECT (SELECT COUNT(*) FROM accounts_raw) AS accounts_loaded,
         COUNT(*) AS sessions_loaded,
         COUNT(*) FILTER (WHERE dq_reason IS NULL) AS sessions_valid,
         COUNT(*) FILTER (WHERE dq_reason IS NOT NULL) AS sessions_quarantined,
         (SELECT COUNT(*) FROM fact) AS fact_rows,
         (SELECT COUNT(DISTINCT user_id) FROM fact) AS distinct_users
  FROM classified),
daily AS (SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY activity_date)
SELECT 'counts' AS section, 'accounts_loaded' AS key, CAST(accounts_loaded AS DOUBLE) AS value FROM report
UNION ALL SELECT 'counts', 'sessions_loaded', CAST(sessions_loaded AS DOUBLE) FROM report
UNION ALL SELECT 'counts', 'sessions_valid', CAST(sessions_valid AS DOUBLE) FROM report
UNION ALL SELECT 'counts', 'sessions_quarantined', CAST(sessions_quarantined AS DOUBLE) FROM report
UNION ALL SELECT 'counts', 'fact_rows', CAST(fact_rows AS DOUBLE) FROM report
UNION ALL SELECT 'counts', 'distinct_users', CAST(distinct_users AS DOUBLE) FROM report
UNION ALL SELECT 'counts', 'avg_daily_dau', COALESCE((SELECT AVG(dau) FROM daily), 0.0)
UNION ALL SELECT 'quarantine', dq_reason, CAST(COUNT(*) AS DOUBLE) FROM classified WHERE dq_reason IS NOT NULL GROUP BY dq_reason
UNION ALL SELECT * FROM (SELECT 'dau_last5', strftime(activity_date, '%Y-%m-%d'), CAST(dau AS DOUBLE) FROM daily
                         ORDER BY activity_date DESC LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'top5_countries', country, CAST(COUNT(DISTINCT user_id) AS DOUBLE) AS v FROM fact
                         GROUP BY country ORDER BY v DESC, country LIMIT 5)
UNION ALL SELECT 'dau_by_platform', platform, CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM fact GROUP BY platform
"""


def _ccu_sql(where: str = "") -> str:
    return f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour,
       CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_ccu
FROM events WHERE ts IS NOT NULL {where}
GROUP BY 1
"""


CCU_SQL = _ccu_sql()
CCU_RANGE_SQL = _ccu_sql(f"AND ts >= {_ts(S.CCU_RANGE[0])} AND ts <= {_ts(S.CCU_RANGE[1])}")

STRICT_VALID_SQL = with_ctes(SESSIONS_CTE) + """
SELECT user_id, ts AS "timestamp", duration, platform, CAST(ts AS DATE) AS event_date FROM (
  SELECT *, try_strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS ts FROM sessions_raw)
WHERE ts IS NOT NULL AND user_id IS NOT NULL AND length(user_id) > 0
  AND platform IS NOT NULL AND length(platform) > 0 AND duration IS NOT NULL AND duration >= 0
"""

WINDOW_SQL = with_ctes(SESSIONS_CTE, window_cte("win", S.RUN_WINDOW)) + "SELECT * FROM win\n"

FACT_WINDOW_SQL = with_ctes(
    SESSIONS_CTE, window_cte("win", S.RUN_WINDOW), classified_cte("classified_w", "win"), accounts_cte(),
    fact_cte("fact_w", "classified_w"),
) + "SELECT * FROM fact_w\n"

_FILTERS = (f"activity_date BETWEEN {_d(S.FILTER_START)} AND {_d(S.FILTER_END)}")

_BAD_LINE = f"event_id % {FX.MALFORMED_LINE_EVERY} = 0"
JSON_POLICY_SQL = with_ctes(SESSIONS_CTE, classified_cte("c", "(SELECT * FROM sessions_base) x")) + f"""
SELECT IF({_BAD_LINE}, NULL, b.user_id) AS user_id, IF({_BAD_LINE}, NULL, b."timestamp") AS "timestamp",
       IF({_BAD_LINE}, NULL, b.duration) AS duration, IF({_BAD_LINE}, NULL, b.platform) AS platform,
       IF({_BAD_LINE}, 'malformed_record', COALESCE({", ".join(f"IF({fault}, '{reason}', NULL)" for reason, fault in _FAULTS.items())})) AS dq_reason
FROM sessions_base b
"""

_USABLE = f"event_id % {FX.BAD_MINUTE_EVERY} <> 0 AND event_id % {FX.BAD_CCU_EVERY} <> 0"


def _two_runs_sql() -> str:
    parts = [f"""SELECT user_id, "timestamp", duration, platform, dq_reason, '{w.extract_start}_{w.end_date}' AS run
FROM classified{i} WHERE dq_reason IS NOT NULL""" for i, w in ((1, S.FIRST_LOAD), (2, S.SECOND_LOAD))]
    return with_ctes(SESSIONS_CTE, window_cte("win1", S.FIRST_LOAD), window_cte("win2", S.SECOND_LOAD),
                     classified_cte("classified1", "win1"), classified_cte("classified2", "win2")) + "\nUNION ALL ".join(parts)


ORACLE: dict[str, str] = {
    "sessions_json_policy": JSON_POLICY_SQL,
    "session_records": JSON_POLICY_SQL,
    "ccu_hourly_dirty_csv": _ccu_sql("AND " + _USABLE),
    "ccu_reject_counts": f"""
SELECT IF(event_id % {FX.BAD_MINUTE_EVERY} = 0, 'bad_time', 'bad_value') AS reject, COUNT(*) AS n FROM events WHERE NOT ({_USABLE}) GROUP BY 1""",
    "roundtrip_accounts_csv_quoted": BASE + """SELECT user_id, '"The", ' || country || ' "of" old' AS country,
       created_at, updated_at FROM accounts_raw""",
    "quarantine_two_runs": _two_runs_sql(),
    "fact_upsert_any_dates": with_ctes(SESSIONS_CTE, classified_cte(), accounts_cte("", 2), fact_cte())
    + "SELECT activity_date, user_id, country, platform FROM fact",
    "fact_empty_then_load": FACT_SQL,
    "stream_quarantine": BASE + 'SELECT user_id, "timestamp", duration, platform, dq_reason FROM classified WHERE dq_reason IS NOT NULL',
    "kpi_gap_range": _kpi_sql(_range_custom(S.GAP, S.GAP)),
    "kpi_slice": _kpi_slice_sql(_range_last_n(S.LAST_N_DAYS), S.FILTER_COUNTRY, S.FILTER_PLATFORM),
    "kpi_slice_never_seen": _kpi_slice_sql(_range_custom(S.CUSTOM_FROM, S.CUSTOM_TO), "NATION_99", "fridge"),
    "avg_dau_by_platform_in": _avg_by_platform_in_sql(_range_custom(S.CUSTOM_FROM, S.CUSTOM_TO), S.FILTER_COUNTRY, S.PLATFORMS),
    "cube_export_totals": BASE + """
SELECT 'country' AS "by", country AS name, COUNT(DISTINCT user_id) AS users FROM fact WHERE country <> 'UNKNOWN' GROUP BY 2
UNION ALL SELECT 'platform', platform, COUNT(DISTINCT user_id) FROM fact GROUP BY 2""",
    "cube_export_lists": CUBE_BASE + "SELECT 'countries' AS list, country AS name, CAST(ROW_NUMBER() OVER (ORDER BY list_position(["
    + ", ".join(f"'{x}'" for x in S.ALLOW_LIST) + "], country)) AS INTEGER) AS position FROM "
    "(SELECT DISTINCT country FROM cube WHERE level = 'day_country' AND country IN (" + ", ".join(f"'{x}'" for x in S.ALLOW_LIST) + "))"
    + "".join(f" UNION ALL SELECT 'platforms', '{p}', {i + 1}" for i, p in enumerate(S.PLATFORMS)),
    "dau_daily": BASE + "SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1",
    "dau_daily_filtered": BASE + f"SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact WHERE {_FILTERS} "
    f"AND country = '{S.FILTER_COUNTRY}' AND platform = '{S.FILTER_PLATFORM}' GROUP BY 1",
    "dau_daily_platform_filtered": BASE + f"SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact "
    f"WHERE {_FILTERS} AND platform = '{S.FILTER_PLATFORM}' GROUP BY 1",
    "dau_by_country": BASE + "SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1",
    "dau_by_platform": BASE + "SELECT platform, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1",
    "dau_by_country_range": BASE + f"SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact WHERE {_FILTERS} GROUP BY 1",
    "dau_by_platform_range": BASE + f"SELECT platform, COUNT(DISTINCT user_id) AS dau FROM fact WHERE {_FILTERS} GROUP BY 1",
    "dau_total": BASE + "SELECT COUNT(DISTINCT user_id) AS distinct_users FROM fact",
    "dau_avg_daily": BASE + "SELECT COALESCE(AVG(dau), 0.0) AS avg_daily_dau, COUNT(*) AS active_days FROM "
    "(SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1)",
    "dau_day_country": BASE + "SELECT activity_date, country, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1, 2",
    "dau_day_platform": BASE + "SELECT activity_date, platform, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1, 2",
    "dau_day_country_platform": BASE + "SELECT activity_date, country, platform, COUNT(DISTINCT user_id) AS dau "
    "FROM fact GROUP BY 1, 2, 3",
    "dau_cube": CUBE_BASE + "SELECT activity_date, level, country, platform, dau FROM cube",
    "dau_known_countries": BASE + "SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact WHERE country <> 'UNKNOWN' GROUP BY 1",
    "dau_unknown_users": BASE + "SELECT COUNT(DISTINCT user_id) AS unknown_users FROM fact WHERE country = 'UNKNOWN'",
    "dau_last5_days": BASE + "SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1 "
    "ORDER BY activity_date DESC LIMIT 5",
    "dau_top5_countries": BASE + "SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1 "
    "ORDER BY dau DESC, country LIMIT 5",
    "fact_daily_user_activity": FACT_SQL,
    "fact_grain_check": BASE + "SELECT COUNT(*) AS fact_rows, COUNT(DISTINCT (activity_date, user_id, platform)) AS distinct_keys, "
    "COUNT(*) = COUNT(DISTINCT (activity_date, user_id, platform)) AS is_unique FROM fact",
    "fact_data_checks": BASE.rstrip() + """,
daily AS (SELECT activity_date, COUNT(DISTINCT user_id) AS total FROM fact GROUP BY 1),
pp AS (SELECT activity_date, MAX(dau) AS mx, SUM(dau) AS sm FROM (
  SELECT activity_date, platform, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1, 2) GROUP BY 1)
SELECT COUNT(*) AS fact_rows,
       COUNT(*) - COUNT(DISTINCT (activity_date, user_id, platform)) AS duplicate_keys,
       COUNT(*) FILTER (WHERE activity_date IS NULL OR user_id IS NULL OR country IS NULL OR platform IS NULL) AS null_fields,
       (SELECT COUNT(*) FILTER (WHERE d.total > p.sm OR d.total < p.mx) FROM daily d JOIN pp p USING (activity_date))
         AS platform_bound_violations
FROM fact
""",
    "dq_balance": BASE + """SELECT COUNT(*) AS sessions_loaded, COUNT(*) FILTER (WHERE dq_reason IS NULL) AS sessions_valid,
       COUNT(*) FILTER (WHERE dq_reason IS NOT NULL) AS sessions_quarantined,
       COUNT(*) FILTER (WHERE dq_reason IS NULL) + COUNT(*) FILTER (WHERE dq_reason IS NOT NULL) = COUNT(*) AS balanced
FROM classified""",
    "accounts_one_per_user": BASE + "SELECT user_id, country, created_at, updated_at FROM accounts_one",
    "dq_classified_sessions": BASE + 'SELECT user_id, "timestamp", duration, platform, dq_reason FROM classified',
    "dq_counts": BASE + "SELECT dq_reason, COUNT(*) AS n FROM classified WHERE dq_reason IS NOT NULL GROUP BY 1",
    "dq_totals": BASE + f"""SELECT COUNT(*) AS sessions_loaded, COUNT(*) FILTER (WHERE dq_reason IS NULL) AS sessions_valid,
       COUNT(*) FILTER (WHERE dq_reason IS NOT NULL) AS sessions_quarantined, {_Q_COLS} FROM classified""",
    "dq_quarantined_sessions": BASE + 'SELECT user_id, "timestamp", duration, platform, dq_reason FROM classified '
    "WHERE dq_reason IS NOT NULL",
    "sessions_staging_view": with_ctes(SESSIONS_CTE) + """
SELECT user_id, TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", duration, platform,
       CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS activity_date
FROM sessions_raw
WHERE user_id IS NOT NULL AND TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL AND platform IS NOT NULL AND duration >= 0
""",
    "sessions_strict_valid": STRICT_VALID_SQL,
    "sessions_window_extract": WINDOW_SQL,
    "fact_reprocess_window": FACT_WINDOW_SQL,
    "fact_upsert_replace": _two_loads_sql("replace"),
    "fact_merge_insert_only": _two_loads_sql("insert_only"),
    "fact_rerun_idempotent": FACT_SQL,
    "cube_incremental_refresh": with_ctes(*_two_loads_ctes("replace"), CUBE_CTE)
    + "SELECT activity_date, level, country, platform, dau FROM cube\n",
    "ccu_hourly": CCU_SQL,
    "ccu_hourly_range": CCU_RANGE_SQL,
    "ccu_peak": f"""
SELECT hour, strftime(hour, '%H:%M') AS hour_label, peak_ccu FROM (
  SELECT hour, ROUND(avg_ccu, 1) AS peak_ccu FROM ({CCU_SQL}))
ORDER BY peak_ccu DESC, hour ASC LIMIT 1
""",
    "ccu_hourly_from_csv": CCU_SQL,
    "axis_meta": BASE + """
SELECT MIN(activity_date) AS min_date, MAX(activity_date) AS max_date, COUNT(DISTINCT activity_date) AS n_days,
       ROUND(COUNT(DISTINCT activity_date) / 365.25, 1) AS span_years,
       COUNT(DISTINCT user_id) AS total_users,
       COUNT(DISTINCT user_id) FILTER (WHERE country = 'UNKNOWN') AS unknown_users
FROM fact
""",
    "cube_dense_country": _dense_sql("country"),
    "cube_dense_platform": _dense_sql("platform"),
    "cube_export_json": CUBE_BASE.rstrip() + """,
slices AS (SELECT DISTINCT level, country, platform FROM cube)
SELECT s.level, s.country, s.platform, a.activity_date, CAST(COALESCE(c.dau, 0) AS BIGINT) AS dau
FROM slices s CROSS JOIN axis a
LEFT JOIN cube c ON c.level = s.level AND c.country IS NOT DISTINCT FROM s.country
     AND c.platform IS NOT DISTINCT FROM s.platform AND c.activity_date = a.activity_date
""",
    "country_allow_list": CUBE_BASE + "SELECT country, CAST(ROW_NUMBER() OVER (ORDER BY list_position(["
    + ", ".join(f"'{x}'" for x in S.ALLOW_LIST) + "], country), country) AS INTEGER) AS position "
    "FROM (SELECT DISTINCT country FROM cube WHERE level = 'day_country' AND country <> 'UNKNOWN' AND country IN ("
    + ", ".join(f"'{x}'" for x in S.ALLOW_LIST) + "))",
    "country_list_default": CUBE_BASE + "SELECT country, CAST(ROW_NUMBER() OVER (ORDER BY country) AS INTEGER) AS position "
    "FROM (SELECT DISTINCT country FROM cube WHERE level = 'day_country' AND country <> 'UNKNOWN')",
    "cube_slice_series": CUBE_BASE.rstrip() + f""",
{_range_custom(S.CUSTOM_FROM, S.CUSTOM_TO)}
SELECT a.activity_date, CAST(COALESCE(c.dau, 0) AS BIGINT) AS dau
FROM axis a CROSS JOIN bounds b
LEFT JOIN cube c ON c.level = 'day_country_platform' AND c.activity_date = a.activity_date
     AND c.country = '{S.FILTER_COUNTRY}' AND c.platform = '{S.FILTER_PLATFORM}'
WHERE a.activity_date BETWEEN b.lo AND b.hi
""",
    "kpi_range": _kpi_sql(_range_all()),
    "kpi_last_n": _kpi_sql(_range_last_n(S.LAST_N_DAYS)),
    "kpi_custom_range": _kpi_sql(_range_custom(S.CUSTOM_FROM, S.CUSTOM_TO)),
    "avg_dau_by_country": _avg_by_country_sql(_range_last_n(S.LAST_N_DAYS)),
    "avg_dau_by_platform": _avg_by_platform_sql(_range_custom(S.CUSTOM_FROM, S.CUSTOM_TO)),
    "avg_dau_by_country_allow_list": _avg_by_country_sql(_range_all(), S.ALLOW_LIST),
    "roundtrip_accounts_csv": BASE + "SELECT user_id, country, created_at, updated_at FROM accounts_raw",
    "roundtrip_sessions_jsonl": WINDOW_SQL,
    "roundtrip_typed_sessions": with_ctes(SESSIONS_CTE) + f"""
SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp", duration, platform FROM (
  SELECT *, try_strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS ts FROM sessions_raw)
WHERE ts IS NOT NULL AND user_id IS NOT NULL AND length(user_id) > 0
  AND platform IS NOT NULL AND length(platform) > 0 AND duration IS NOT NULL AND duration >= 0
  AND ts >= {_ts(S.RUN_WINDOW.extract_start)} AND ts < {_ts(S.RUN_WINDOW.extract_end)}
""",
    "roundtrip_fact_parquet": FACT_SQL,
    "roundtrip_fact_csv": FACT_SQL,
    "roundtrip_quarantine": BASE + 'SELECT user_id, "timestamp", duration, platform, dq_reason FROM classified '
    "WHERE dq_reason IS NOT NULL",
    "roundtrip_quality_report": QUALITY_REPORT_SQL,
    "quality_report": QUALITY_REPORT_SQL,
    "run_summary": RUN_SUMMARY_SQL,
    "stream_fact": FACT_SQL,
    "stream_ccu_hourly": CCU_SQL,
    "fact_publish_checked": _two_loads_sql("replace"),
    "fact_clustered_loads": _two_loads_sql("replace"),
    "stream_dau_preview": CUBE_BASE + "SELECT activity_date, level, country, platform, dau, true AS close FROM cube",
    "fact_publish_insert_only": _two_loads_sql("insert_only"),
    "change_feed": with_ctes(*_SCATTERED_CTES) + f"""
, before AS (SELECT activity_date, COUNT(*) AS n FROM batch1 GROUP BY 1)
, after AS (SELECT activity_date, COUNT(*) AS n FROM fact GROUP BY 1)
SELECT 1 AS load_number, activity_date, CAST(0 AS BIGINT) AS rows_before, n AS rows_after FROM before
UNION ALL
SELECT 2, a.activity_date, COALESCE(b.n, 0), a.n FROM after a LEFT JOIN before b USING (activity_date)
WHERE a.activity_date IN (SELECT activity_date FROM (SELECT * FROM every_day WHERE {_SCATTERED} EXCEPT SELECT * FROM batch1))""",
    "cube_follow_changes": with_ctes(*_SCATTERED_CTES, CUBE_CTE) + "SELECT activity_date, level, country, platform, dau FROM cube",
    "export_follow_totals": with_ctes(*_SCATTERED_CTES) + """
SELECT 'country' AS "by", country AS name, COUNT(DISTINCT user_id) AS users FROM fact WHERE country <> 'UNKNOWN' GROUP BY 2
UNION ALL SELECT 'platform', platform, COUNT(DISTINCT user_id) FROM fact GROUP BY 2""",
    "export_follow_meta": with_ctes(*_SCATTERED_CTES) + """
SELECT MIN(activity_date) AS min_date, MAX(activity_date) AS max_date, COUNT(DISTINCT activity_date) AS n_days,
       ROUND(COUNT(DISTINCT activity_date) / 365.25, 1) AS span_years, COUNT(DISTINCT user_id) AS total_users,
       COUNT(DISTINCT user_id) FILTER (country = 'UNKNOWN') AS unknown_users FROM fact""",
    "bitmap_users_total": BASE + f"""
SELECT 'all' AS asked, COUNT(DISTINCT user_id) AS distinct_users FROM fact
UNION ALL SELECT 'range', COUNT(DISTINCT user_id) FROM fact WHERE {_FILTERS}
UNION ALL SELECT 'country', COUNT(DISTINCT user_id) FROM fact WHERE {_FILTERS} AND country = '{S.FILTER_COUNTRY}'
UNION ALL SELECT 'platform', COUNT(DISTINCT user_id) FROM fact WHERE {_FILTERS} AND platform = '{S.FILTER_PLATFORM}'
UNION ALL SELECT 'both', COUNT(DISTINCT user_id) FROM fact WHERE {_FILTERS} AND country = '{S.FILTER_COUNTRY}' AND platform = '{S.FILTER_PLATFORM}'""",
    "bitmap_by_country_range": BASE + f"SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact WHERE {_FILTERS} GROUP BY 1",
    "bitmap_by_platform_range": BASE + f"SELECT platform, COUNT(DISTINCT user_id) AS dau FROM fact WHERE {_FILTERS} GROUP BY 1",
    "bitmap_known_countries": BASE + "SELECT country, COUNT(DISTINCT user_id) AS dau FROM fact WHERE country <> 'UNKNOWN' GROUP BY 1",
    "stream_fact_state": FACT_SQL,
    "stream_fact_published": FACT_SQL,
    "stream_fact_late": with_ctes(SESSIONS_CTE, classified_cte(), f"""
valid AS (SELECT ts, CAST(ts AS DATE) BETWEEN {_d(S.FIRST_WAVE[0])} AND {_d(S.FIRST_WAVE[1])} AS early FROM classified WHERE dq_reason IS NULL)""") + f"""
SELECT 'late' AS route, CAST(ts AS DATE) AS event_date, COUNT(*) AS n FROM valid
WHERE NOT early AND ts < (SELECT MAX(ts) FROM valid WHERE early) - INTERVAL {S.STREAM_LOOK_BACK.days} DAY GROUP BY 2""",
    "stream_ccu_event_time": CCU_SQL,
    "stream_ccu_corrections": f"""
WITH usable AS (SELECT date_trunc('second', ts) AS ts, value, CAST(ts AS DATE) BETWEEN {_d(S.FIRST_WAVE[0])} AND {_d(S.FIRST_WAVE[1])} AS early
                FROM events WHERE ts IS NOT NULL AND {_USABLE}),
marked AS (SELECT *, NOT early AND ts < (SELECT MAX(ts) FROM usable WHERE early) - INTERVAL {CCU_LATENESS_HOURS} HOUR AS late FROM usable)
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour,
       CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_ccu,
       COUNT(value) AS minutes, COUNT(value) FILTER (late) AS late_minutes
FROM marked GROUP BY 1""",
    "stream_dau": BASE + "SELECT activity_date, COUNT(DISTINCT user_id) AS dau FROM fact GROUP BY 1",
}
