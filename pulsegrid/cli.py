"""Command line: ``python -m pulsegrid.cli run|ccu|cubes ...`` (or via spark-submit).

Options override the PULSEGRID_* environment, which overrides defaults. With a catalog table
(PULSEGRID_FACT_TABLE) ``run`` publishes its loads through it, and ``cubes`` follows them."""

from __future__ import annotations

import argparse
import sys

from pulsegrid.config import JobConfig
from pulsegrid.constants import PLATFORM_ORDER


def _list(text: str | None) -> list[str] | None:
    return [x.strip() for x in text.split(",") if x.strip()] if text else None


# What each command does, and its options: (flag, the JobConfig field it sets or None, argparse settings).
COMMANDS = {
    "run": "extract window -> quality -> fact upsert -> DAU summary",
    "ccu": "hourly mean of minute-level concurrent users",
    "cubes": "build or refresh the DAU cube table and its export",
}
WINDOW_END = ("--end-date", "end_date", {})
WINDOW = [("--start-date", "start_date", {}), WINDOW_END, ("--reprocess-window", "reprocess_days", {"type": int})]
OPTIONS = {
    "run": [*WINDOW, ("--upsert-mode", "upsert_mode", {"choices": ["replace", "insert_only"]})],
    "ccu": [WINDOW_END],
    "cubes": [
        *WINDOW,
        ("--full", None, {"action": "store_true", "help": "rebuild every date instead of the run window"}),
        ("--countries", None, {"help": "comma-separated countries to offer, in order (default: all present)"}),
        ("--platforms", None, {"default": ",".join(PLATFORM_ORDER), "help": "comma-separated platforms to offer, in order; empty: those present"}),
    ],
}


def parse(argv: list[str] | None) -> tuple[argparse.Namespace, JobConfig]:
    """The command's options, and the configuration with those of them that were given."""
    ap = argparse.ArgumentParser(prog="pulsegrid", description="Daily activity analytics on Spark")
    commands = ap.add_subparsers(dest="command", required=True)
    for command, purpose in COMMANDS.items():
        one = commands.add_parser(command, help=purpose)
        for flag, field, settings in OPTIONS[command]:
            one.add_argument(flag, **({"dest": field} if field else {}), **settings)
    args = ap.parse_args(argv)
    given = {field: value for _, field, _ in OPTIONS[args.command] if field and (value := vars(args)[field]) not in (None, "")}
    return args, JobConfig.from_env(**given)


def _print_all(df) -> None:
    """Every row, a partition at a time, so that a long result is neither cut nor gathered."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join(str(x) for x in row))


def _run(spark, args, cfg) -> None:
    from pulsegrid.plans.daily_activity import run_daily_activity

    out = run_daily_activity(spark, cfg)
    _print_all(out.summary)
    print(f"fact table: {out.fact_path}; raw files: {out.raw_path}; CSV: {out.csv_path}; report: {out.report_path}; "
          f"quarantine: {out.quarantine_path}")


def _ccu(spark, args, cfg) -> None:
    from pulsegrid.plans.hourly_ccu import run_hourly_ccu

    out = run_hourly_ccu(spark, cfg)
    _print_all(out.hourly.orderBy("hour"))
    _print_all(out.peak)
    print(f"hourly means: {out.hourly_path}; minutes left out: {out.rejects or 'none'}")


def _cubes(spark, args, cfg) -> None:
    from pulsegrid.operators.tables import read_fact_if_exists
    from pulsegrid.plans.cube_build import build_cubes, follow_loads
    from pulsegrid.sources.readers import read_ccu_csv

    lists = {"countries": _list(args.countries), "platforms": _list(args.platforms)}
    if cfg.fact_table and not args.full:
        out = follow_loads(spark, cfg.fact_table, cfg.output_dir, **lists)
        print(f"days brought up to date: {', '.join(map(str, out.dates)) or 'none'}; export: {out.export_path}")
        return
    fact = spark.table(cfg.fact_table) if cfg.fact_table else read_fact_if_exists(spark, cfg.fact_path)
    bounds = None if args.full else (cfg.window.extract_start, cfg.window.end_date)
    ccu = read_ccu_csv(spark, cfg.ccu_path) if cfg.ccu_path else None
    out = build_cubes(spark, fact, ccu, out_dir=cfg.output_dir, date_bounds=bounds, **lists)
    _print_all(out.meta)
    print(f"cube table: {out.cube_path}; export: {out.export_path}")


def main(argv: list[str] | None = None) -> int:
    args, cfg = parse(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"pulsegrid-{args.command}").getOrCreate()
    {"run": _run, "ccu": _ccu, "cubes": _cubes}[args.command](spark, args, cfg)
    return 0


if __name__ == "__main__":
    sys.exit(main())
