"""Property tests: upsert modes and range KPIs against brute force on random small inputs."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsegrid.operators import cubes
from pulsegrid.operators.tables import merge_rows

SCHEMA = "activity_date date, user_id string, country string, platform string"
DAYS = [date(2026, 9, 1) + timedelta(days=i) for i in range(6)]

row = st.tuples(st.sampled_from(DAYS), st.sampled_from(["a", "b", "c", "d"]),
                st.sampled_from(["DE", "US", "UNKNOWN"]), st.sampled_from(["W", "A", "I"]))


def _unique(rows):
    """A fact batch is unique on (date, user, platform): keep the first row per key."""
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1], r[3]) not in seen:
            seen.add((r[0], r[1], r[3]))
            out.append(r)
    return out


FAST = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@FAST
@given(st.lists(row, max_size=12), st.lists(row, max_size=12), st.sampled_from(["replace", "insert_only"]))
def test_merge_rows_matches_brute_force(spark, old, new, mode):
    old, new = _unique(old), _unique(new)
    got = {tuple(r) for r in merge_rows(spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA),
                                        mode).collect()}
    key = lambda r: (r[0], r[1], r[3])
    winners, losers = (new, old) if mode == "replace" else (old, new)
    expected = set(winners) | {r for r in losers if key(r) not in {key(w) for w in winners}}
    assert got == expected


@FAST
@given(st.lists(row, min_size=1, max_size=15), st.integers(min_value=1, max_value=8))
def test_kpis_match_brute_force(spark, rows, n):
    rows = _unique(rows)
    cube = cubes.build_cube(spark.createDataFrame(rows, SCHEMA))
    got = {(r["level"], r["country"], r["platform"]): r for r in
           cubes.kpis_by_slice(cube, cubes.axis_range_last_n(cube, n)).collect()}
    axis = sorted({r[0] for r in rows})
    window = axis[-n:]
    slices = {("day", None, None)} | {("day_country", r[2], None) for r in rows} | \
        {("day_platform", None, r[3]) for r in rows} | {("day_country_platform", r[2], r[3]) for r in rows}
    assert set(got) == slices
    for lvl, c, p in slices:
        daily = []
        for d in window:
            users = {r[1] for r in rows if r[0] == d and (c is None or r[2] == c) and (p is None or r[3] == p)}
            daily.append((len(users), d))
        k = got[(lvl, c, p)]
        peak = max(daily)  # ties -> latest date
        assert k["player_days"] == sum(v for v, _ in daily)
        assert k["n_days"] == len(window)
        assert abs(k["avg_dau"] - sum(v for v, _ in daily) / len(window)) < 1e-12
        assert k["peak_dau"] == peak[0]
        assert k["peak_date"] == (peak[1] if peak[0] > 0 else window[-1])


ACC_SCHEMA = "user_id string, country string, created_at string, updated_at string"
UPDATED = [None, "garbage", "2026-01-01T00:00:00", "2026-02-01T00:00:00", "2026-02-01 00:00:00"]
account = st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from([None, "DE", "AT", "US"]),
                    st.sampled_from(UPDATED))


@FAST
@given(st.lists(account, min_size=1, max_size=12))
def test_latest_account_matches_brute_force(spark, rows):
    from datetime import datetime

    from pulsegrid.operators.accounts import latest_account_per_user

    def parsed(u):
        try:
            return datetime.fromisoformat(u) if u else None
        except ValueError:
            return None

    def key(r):  # latest updated_at first (unparseable last), then smallest country (NULL last)
        p = parsed(r[2])
        return (p is None, -(p.timestamp() if p else 0), r[1] is None, r[1] or "")

    expected = {}
    for u in {r[0] for r in rows}:
        expected[u] = sorted((r for r in rows if r[0] == u), key=key)[0][1]
    df = spark.createDataFrame([(u, c, "2026-01-01T00:00:00", t) for u, c, t in rows], ACC_SCHEMA)
    got = {r["user_id"]: r["country"] for r in latest_account_per_user(df).collect()}
    assert got == expected
