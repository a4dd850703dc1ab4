"""Benchmark the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}. Each query
is fully materialised with the ``noop`` sink (every row computed, nothing collected to the
driver). Before timing, every headline query runs once, untimed, on the smaller sf0.01
fixture: that compiles the generated code and warms the JIT, as on a long-running cluster.
The timed runs read the full ``$BENCH_SF_DIR`` tables; no data is cached between queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "fact_daily_user_activity",
    "dau_daily",
    "dau_by_country",
    "dau_day_country_platform",
    "dau_cube",
    "kpi_range",
    "avg_dau_by_platform",
    "dq_counts",
    "quality_report",
    "ccu_hourly",
    "ccu_peak",
    "accounts_one_per_user",
    "fact_reprocess_window",
    "fact_upsert_replace",
    "run_summary",
    "stream_fact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pulsegrid.plans.catalog import QUERIES
    from pulsegrid.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="pulsegrid-bench", shuffle_partitions=cpus)

    def run(name: str, sf: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warm_dir = "/root/testdata/sf0.01"
    if Path(warm_dir).exists() and Path(warm_dir) != Path(sf_dir):
        for name in HEADLINE:
            run(name, warm_dir)

    times = {name: round(run(name, sf_dir), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
