"""Parameters of the registered queries (dates fall inside the fixtures' 2024-01-01..30)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pulsegrid.config import Window

# Filter and window parameters shared by the Spark queries and their SQL.
FILTER_START = date(2024, 1, 5)
FILTER_END = date(2024, 1, 25)
FILTER_COUNTRY = "NATION_1"
FILTER_PLATFORM = "click"

RUN_WINDOW = Window(end_date=date(2024, 1, 25), start_date=date(2024, 1, 15), reprocess_days=7)
FIRST_LOAD = Window(end_date=date(2024, 1, 20), start_date=date(2024, 1, 1), reprocess_days=0)
SECOND_LOAD = Window(end_date=date(2024, 1, 30), start_date=date(2024, 1, 15), reprocess_days=7)

CCU_RANGE = (datetime(2024, 1, 10, 6, 0, 0), datetime(2024, 1, 12, 18, 0, 0))

LAST_N_DAYS = 7
CUSTOM_FROM = date(2024, 1, 5)
CUSTOM_TO = date(2024, 1, 12)
ALLOW_LIST = ["NATION_3", "NATION_0", "NATION_24", "NATION_7", "NATION_99"]
GAP = date(2024, 1, 14)  # a day of the fixtures without sessions
PLATFORMS = ["view", "fridge", "click", "purchase"]  # offered in this order; "fridge" is never seen
STREAM_FILES = 12  # files a micro-batch takes: the landed sessions make several batches
FIRST_WAVE = (date(2024, 1, 10), date(2024, 1, 19))  # the days of the streams that land first
STREAM_LOOK_BACK = timedelta(days=12)  # so some of the days before the first wave are on time
SCATTERED = [date(2024, 1, 2), date(2024, 1, 9), date(2024, 1, 17), date(2024, 1, 28)]  # the days of a late batch
BUCKETS = 8  # clustering by user in the fixtures
