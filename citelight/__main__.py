"""Command line of the runs, for spark-submit.

    python -m citelight extract --landing L --warehouse W [--backfill]
    python -m citelight refresh --warehouse W [--changed | --since 2026-04-21T00:00:00]
    python -m citelight report  --landing L --warehouse W [--start 2026-01-01 [--end 2026-03-31]]
    python -m citelight by-date --landing L --warehouse W
    python -m citelight reset   --warehouse W

The exit code is 1 when some payload could not be used; the others are loaded.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from .plans import runs
from .session import build_session
from .sources.freshness import report_window


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="citelight")
    parser.add_argument("--run-time", type=datetime.fromisoformat, default=datetime.now(timezone.utc))
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("extract", "refresh", "report", "by-date", "reset"):
        command = commands.add_parser(name)
        command.add_argument("--warehouse", required=True)
        if name in ("extract", "report", "by-date"):
            command.add_argument("--landing", required=True)
        if name == "extract":
            command.add_argument("--backfill", action="store_true")
        if name == "refresh":
            command.add_argument("--since", type=datetime.fromisoformat)
            command.add_argument("--changed", action="store_true")
        if name == "report":
            command.add_argument("--start", type=date.fromisoformat)
            command.add_argument("--end", type=date.fromisoformat)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Carry out one command; the exit code."""
    house = runs.Warehouse(args.warehouse)
    result = runs.RunResult()
    if args.command == "extract":
        result = runs.load_raw(spark, args.landing, house, args.run_time, backfill=args.backfill)
    elif args.command == "report":
        window = report_window(args.run_time.date(), args.start, args.end)
        result = runs.load_report(spark, args.landing, house, args.run_time, window, backfill=args.start is not None)
    elif args.command == "by-date":
        result = runs.load_by_date(spark, args.landing, house, args.run_time)
    elif args.command == "refresh" and (args.changed or args.since is not None):
        runs.incremental_refresh(spark, house, args.since)
    elif args.command == "refresh":
        runs.full_refresh(spark, house)
    else:
        runs.reset(spark, house)
    for endpoint, payloads in result.failed.items():
        if payloads:
            print(f"{endpoint}: {payloads} payloads set aside", file=sys.stderr)
    return 0 if result.ok else 1


if __name__ == "__main__":
    sys.exit(run(build_session(), arguments()))
