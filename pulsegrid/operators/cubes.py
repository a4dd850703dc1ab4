"""Date-aligned DAU cube and the slices/KPIs computed on it (A12, A17, A19-A23, F13, F15-F17,
J3, K7).

The cube is a long table ``(activity_date, level, country, platform, dau)``; ``country`` /
``platform`` are NULL where the level rolls them up. All four levels come from one scan via
grouping sets (one Expand, one two-phase distinct aggregate).

Dense alignment (a value for every axis date, 0 when absent) is only materialised where it
is the output itself (J3, K7). KPIs divide by the number of axis days in range instead, so
they need no densification. The axis (distinct dates that have data) grows with the length
of history, not with data volume: about 365 entries a year.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.constants import DAYS_PER_YEAR, UNKNOWN_COUNTRY
from pulsegrid.operators.numbering import number_rows

# Cube level names by grouping id over (activity_date, country, platform).
LEVEL_DAY = "day"
LEVEL_DAY_COUNTRY = "day_country"
LEVEL_DAY_PLATFORM = "day_platform"
LEVEL_DAY_COUNTRY_PLATFORM = "day_country_platform"
LEVEL_BY_GROUPING_ID = {3: LEVEL_DAY, 1: LEVEL_DAY_COUNTRY, 2: LEVEL_DAY_PLATFORM, 0: LEVEL_DAY_COUNTRY_PLATFORM}


def build_cube(fact: DataFrame) -> DataFrame:
    """DAU per day, day x country, day x platform, day x country x platform."""
    g = fact.groupingSets(
        [["activity_date"], ["activity_date", "country"], ["activity_date", "platform"],
         ["activity_date", "country", "platform"]],
        "activity_date", "country", "platform",
    ).agg(F.count_distinct("user_id").alias("dau"), F.grouping_id().alias("gid"))
    level = None
    for gid, name in LEVEL_BY_GROUPING_ID.items():
        level = F.when(F.col("gid") == gid, F.lit(name)) if level is None else level.when(F.col("gid") == gid, F.lit(name))
    return g.select("activity_date", level.alias("level"), "country", "platform", "dau")


def _level(cube: DataFrame, name: str) -> DataFrame:
    return cube.where(F.col("level") == F.lit(name))


def date_axis(cube: DataFrame) -> DataFrame:
    """The axis: every date that has activity (one row per date at the ``day`` level)."""
    return _level(cube, LEVEL_DAY).select("activity_date")


def axis_meta(fact: DataFrame) -> DataFrame:
    """A17 + totals: min/max date, number of axis days, span in years (1 decimal), distinct
    users and distinct UNKNOWN-country users."""
    n_days = F.count_distinct("activity_date")
    return fact.agg(
        F.min("activity_date").alias("min_date"),
        F.max("activity_date").alias("max_date"),
        n_days.alias("n_days"),
        F.round(n_days / F.lit(DAYS_PER_YEAR), 1).alias("span_years"),
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct(F.when(F.col("country") == F.lit(UNKNOWN_COUNTRY), F.col("user_id"))).alias("unknown_users"),
    )


def _ranked(present: DataFrame, name: str, order: list[str] | None) -> DataFrame:
    """``(name, position)`` of a distinct list: in the given order, else by name. Numbered by ranges, so a list of any length
    passes through no single task."""
    by = [name]
    if order:
        places = F.array(*[F.lit(x) for x in dict.fromkeys(order)])
        present = present.where(F.col(name).isin(list(order))).withColumn("place", F.array_position(places, F.col(name)))
        by = ["place"]
    return number_rows(present, by).select(name, F.col("position").cast("int").alias("position")).orderBy("position")


def country_allow_list(cube: DataFrame, allow: list[str] | None = None) -> DataFrame:
    """The countries offered for slicing, in order: those of ``allow`` present in
    the data (allow-list order), or all known (non-UNKNOWN) countries by name."""
    present = _level(cube, LEVEL_DAY_COUNTRY).select("country").distinct().where(
        F.col("country") != F.lit(UNKNOWN_COUNTRY))
    return _ranked(present, "country", allow)


def platform_list(cube: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """``(platform, position)``. A given list is offered as it is, absent platforms too;
    without one, the platforms present by name."""
    if platforms:
        rows = [(p, i + 1) for i, p in enumerate(dict.fromkeys(platforms))]
        return cube.sparkSession.createDataFrame(rows, "platform string, position int")
    return _ranked(_level(cube, LEVEL_DAY_PLATFORM).select("platform").distinct(), "platform", None)


# ---- axis ranges (F16, F17): each returns a one-row DataFrame (lo, hi) ----

def axis_range_all(cube: DataFrame) -> DataFrame:
    return date_axis(cube).agg(F.min("activity_date").alias("lo"), F.max("activity_date").alias("hi"))


def axis_range_last_n(cube: DataFrame, n: int) -> DataFrame:
    """F16: the last ``n`` axis dates (dates with data, not calendar days)."""
    return (
        date_axis(cube).orderBy(F.desc("activity_date")).limit(int(n))
        .agg(F.min("activity_date").alias("lo"), F.max("activity_date").alias("hi"))
    )


def axis_range_custom(cube: DataFrame, from_date: date | None, to_date: date | None) -> DataFrame:
    """snap a from/to pair to axis dates: lo = first date >= from (else the first axis
    date), hi = last date <= to (else the last); swapped when lo > hi, so a range inside a
    gap selects its two neighbours."""
    d = F.col("activity_date")
    lo0 = F.min(F.when(d >= F.lit(from_date), d)) if from_date is not None else F.min(d)
    hi0 = F.max(F.when(d <= F.lit(to_date), d)) if to_date is not None else F.max(d)
    snapped = date_axis(cube).agg(
        F.coalesce(lo0, F.min(d)).alias("lo0"), F.coalesce(hi0, F.max(d)).alias("hi0")
    )
    return snapped.select(F.least("lo0", "hi0").alias("lo"), F.greatest("lo0", "hi0").alias("hi"))


def _bounds(cube: DataFrame, bounds: DataFrame) -> tuple[Column, Column, Column]:
    """(lo, hi, axis days in [lo, hi]) as literals from one row, so a range is a static
    partition filter on a cube stored by date."""
    b = bounds.first()
    inside = F.col("activity_date").between(F.lit(b["lo"]), F.lit(b["hi"]))
    n = date_axis(cube).where(inside).count() if b["lo"] is not None else 0
    return F.lit(b["lo"]).cast("date"), F.lit(b["hi"]).cast("date"), F.lit(n).cast("long")


def kpis_by_slice(cube: DataFrame, bounds: DataFrame) -> DataFrame:
    """A19-A21 for every slice (level, country, platform) of the cube over [lo, hi]:
    average daily DAU over the axis days in range (absent days count as 0), peak daily DAU
    and its date (ties -> latest date; no data -> 0 on the last day of the range), and
    player-days (sum of daily DAU). Figures are read from the range's dates only; the list of
    slices, three columns of the small cube, adds those without data in the range."""
    lo, hi, n_days = _bounds(cube, bounds)
    names = ["level", "country", "platform"]
    slices = cube.select(*names).distinct()
    agg = cube.where(F.col("activity_date").between(lo, hi)).groupBy(*(F.col(c).alias(f"_{c}") for c in names)).agg(
        F.sum("dau").alias("s"),
        F.max(F.struct(F.col("dau").alias("dau"), F.col("activity_date").alias("d"))).alias("pk"),
    )
    joined = slices.join(agg, (F.col("level") == F.col("_level")) & F.col("country").eqNullSafe(F.col("_country"))
                         & F.col("platform").eqNullSafe(F.col("_platform")), "left")
    return joined.select(*names, *_kpi_columns(lo, hi, n_days))


def _kpi_columns(lo: Column, hi: Column, n_days: Column) -> list[Column]:
    player_days = F.coalesce(F.col("s"), F.lit(0)).cast("long")
    return [
        lo.alias("range_start"),
        hi.alias("range_end"),
        n_days.alias("n_days"),
        F.try_divide(player_days.cast("double"), n_days.cast("double")).alias("avg_dau"),
        F.coalesce(F.col("pk.dau"), F.lit(0)).cast("long").alias("peak_dau"),
        F.coalesce(F.col("pk.d"), hi).alias("peak_date"),
        player_days.alias("player_days"),
    ]


def kpis_of_slice(cube: DataFrame, bounds: DataFrame, country: str | None = None, platform: str | None = None) -> DataFrame:
    """A19-A21 for one chosen slice, in one row: zeros for one that the data never saw."""
    lo, hi, n_days = _bounds(cube, bounds)
    rows = _slice(cube, country, platform).where(F.col("activity_date").between(lo, hi))
    agg = rows.agg(F.sum("dau").alias("s"), F.max(F.struct(F.col("dau").alias("dau"), F.col("activity_date").alias("d"))).alias("pk"))
    return agg.select(F.lit(_chosen(country)).cast("string").alias("country"), F.lit(_chosen(platform)).cast("string").alias("platform"),
                      *_kpi_columns(lo, hi, n_days))


def _chosen(name: str | None) -> str | None:
    return None if name == "All" else name


def _slice(cube: DataFrame, country: str | None, platform: str | None) -> DataFrame:
    """The rows of one slice (``None``/``"All"`` = no filter), from the level that the filters
    imply: a prefiltered, exact distinct count per day."""
    country, platform = _chosen(country), _chosen(platform)
    level = {(False, False): LEVEL_DAY, (True, False): LEVEL_DAY_COUNTRY,
             (False, True): LEVEL_DAY_PLATFORM, (True, True): LEVEL_DAY_COUNTRY_PLATFORM}[
        (country is not None, platform is not None)]
    rows = _level(cube, level)
    if country is not None:
        rows = rows.where(F.col("country") == F.lit(country))
    if platform is not None:
        rows = rows.where(F.col("platform") == F.lit(platform))
    return rows


def slice_series(cube: DataFrame, bounds: DataFrame, country: str | None = None,
                 platform: str | None = None) -> DataFrame:
    """The main chart: daily DAU of one slice for every axis day in [lo, hi], 0 where the
    slice had no users."""
    lo, hi, _ = _bounds(cube, bounds)
    in_range = F.col("activity_date").between(lo, hi)
    rows = _slice(cube, country, platform).where(in_range)
    days = date_axis(cube).where(in_range)
    return days.join(rows.select("activity_date", "dau"), "activity_date", "left").select(
        "activity_date", F.coalesce(F.col("dau"), F.lit(0)).cast("long").alias("dau")
    ).orderBy("activity_date")


def avg_dau_by_country(cube: DataFrame, bounds: DataFrame, allow: list[str] | None = None) -> DataFrame:
    """A22 (+F15, O6): average daily DAU per country over [lo, hi] under every platform
    filter (``platform_filter`` NULL = all platforms). Countries are the allow-list ones
    (UNKNOWN never); zero averages are dropped, as the country chart does."""
    lo, hi, n_days = _bounds(cube, bounds)
    rows = cube.where(
        F.col("level").isin(LEVEL_DAY_COUNTRY, LEVEL_DAY_COUNTRY_PLATFORM)
        & (F.col("country") != F.lit(UNKNOWN_COUNTRY))
        & F.col("activity_date").between(lo, hi)
    )
    if allow:
        rows = rows.where(F.col("country").isin(list(allow)))
    g = rows.groupBy(F.col("platform").alias("platform_filter"), "country").agg(F.sum("dau").alias("s"))
    avg = F.try_divide(F.col("s").cast("double"), n_days.cast("double"))
    # Ties keep the country list's order: allow-list position, else name.
    tie = F.array_position(F.array(*[F.lit(c) for c in allow]), F.col("country")) if allow else F.col("country")
    return (
        g.select("platform_filter", "country", avg.alias("avg_dau"))
        .where(F.col("avg_dau") > 0)
        .orderBy(F.asc_nulls_first("platform_filter"), F.desc("avg_dau"), tie)
    )


def avg_dau_by_platform(cube: DataFrame, bounds: DataFrame, allow: list[str] | None = None) -> DataFrame:
    """A23 (+O6): average daily DAU per platform over [lo, hi] under every country filter that
    has data in the range (``country_filter`` NULL = all countries), in one pass over the
    range. :func:`avg_dau_by_platform_in` fills in the zeros for a chosen filter."""
    lo, hi, n_days = _bounds(cube, bounds)
    rows = cube.where(
        F.col("level").isin(LEVEL_DAY_PLATFORM, LEVEL_DAY_COUNTRY_PLATFORM)
        & F.col("activity_date").between(lo, hi)
        & (F.col("country").isNull() | _known(F.col("country"), allow))
    )
    g = rows.groupBy(F.col("country").alias("country_filter"), "platform").agg(F.sum("dau").alias("s"))
    return g.select(
        "country_filter", "platform", F.try_divide(F.col("s").cast("double"), n_days.cast("double")).alias("avg_dau")
    ).orderBy(F.asc_nulls_first("country_filter"), F.desc("avg_dau"), "platform")


def avg_dau_by_platform_in(cube: DataFrame, bounds: DataFrame, country: str | None = None,
                           platforms: list[str] | None = None) -> DataFrame:
    """A23 for one country filter, as the chart shows it: every platform of the list appears, 0
    where it had no users; ties keep the order of the list."""
    lo, hi, n_days = _bounds(cube, bounds)
    country = _chosen(country)
    rows = _level(cube, LEVEL_DAY_PLATFORM) if country is None else _level(cube, LEVEL_DAY_COUNTRY_PLATFORM).where(
        F.col("country") == F.lit(country))
    sums = rows.where(F.col("activity_date").between(lo, hi)).groupBy("platform").agg(F.sum("dau").alias("s"))
    joined = platform_list(cube, platforms).join(sums, "platform", "left")
    avg = F.try_divide(F.coalesce(F.col("s"), F.lit(0)).cast("double"), n_days.cast("double"))
    return joined.select("platform", "position", avg.alias("avg_dau")).orderBy(F.desc("avg_dau"), "position")


def _known(col: Column, allow: list[str] | None) -> Column:
    cond = col != F.lit(UNKNOWN_COUNTRY)
    return cond & col.isin(list(allow)) if allow else cond


def dense_series(cube: DataFrame, by: str) -> DataFrame:
    """``(by, activity_date, dau)`` for every group x axis date, 0 where the group had no
    users that day. Rows = groups x axis days, which is the output itself."""
    level = LEVEL_DAY_COUNTRY if by == "country" else LEVEL_DAY_PLATFORM
    axis = date_axis(cube).agg(F.sort_array(F.collect_list("activity_date"))).scalar()
    counts = _level(cube, level).select(by, "activity_date", "dau")
    groups = counts.select(by).distinct()
    dense = groups.select(by, F.explode(axis).alias("activity_date"))
    return dense.join(counts, [by, "activity_date"], "left").select(
        by, "activity_date", F.coalesce(F.col("dau"), F.lit(0)).cast("long").alias("dau")
    )


def cube_export_rows(cube: DataFrame) -> DataFrame:
    """K7 export form: one row per slice with its dense series aligned to the axis
    (``series[i]`` belongs to the i-th axis date). Each slice collects exactly one entry per
    axis date, so a row holds at most (days of history) numbers."""
    axis = date_axis(cube).agg(F.sort_array(F.collect_list("activity_date"))).scalar()
    slices = cube.select("level", "country", "platform").distinct()
    dense = slices.select("level", "country", "platform", F.explode(axis).alias("activity_date")).alias("d")
    c = cube.alias("c")
    joined = dense.join(
        c,
        (F.col("d.level") == F.col("c.level"))
        & F.col("d.country").eqNullSafe(F.col("c.country"))
        & F.col("d.platform").eqNullSafe(F.col("c.platform"))
        & (F.col("d.activity_date") == F.col("c.activity_date")),
        "left",
    )
    points = joined.groupBy(F.col("d.level").alias("level"), F.col("d.country").alias("country"),
                            F.col("d.platform").alias("platform")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("d.activity_date").alias("activity_date"),
                                             F.coalesce(F.col("c.dau"), F.lit(0)).cast("long").alias("dau")))).alias("pts")
    )
    return points.select("level", "country", "platform", F.transform("pts", lambda p: p["dau"]).alias("series"))
