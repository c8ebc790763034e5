"""Command line: ``python -m adlake.jobs {bronze,silver,gold,daily,compact,report} ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timedelta, timezone

from adlake.operators.attribution import CLICK_DAYS, CONVERSION_DAYS
from adlake.plans import daily, gold, maintenance, reports, silver
from adlake.schemas import EVENT_TYPES
from adlake.session import build_session
from adlake.sources.tables import Lake
from adlake.sources.topics import read_file_topic, read_kafka_topic
from adlake.streaming import bronze


def parser(today: date) -> argparse.ArgumentParser:
    yesterday = today - timedelta(days=1)
    root = argparse.ArgumentParser(prog="adlake.jobs")
    jobs = root.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("bronze", help="append topics to the raw layer")
    stream.add_argument("--raw-base", required=True)
    stream.add_argument("--checkpoint-base", required=True)
    stream.add_argument("--lake", help="root of the tables; micro-batches are noted there")
    stream.add_argument("--servers", help="Kafka bootstrap servers; topics are folders without")
    for event_type in EVENT_TYPES:
        stream.add_argument(f"--topic-{event_type}", default=f"ad-{event_type}s")
    stream.add_argument("--starting-offsets", choices=("latest", "earliest"), default="latest")
    stream.add_argument("--topic-type", choices=EVENT_TYPES, help="run this one only")
    stream.add_argument("--max-per-trigger", type=int)
    stream.add_argument(
        "--trigger-seconds",
        type=int,
        default=60,
        help="time between micro-batches; each writes files, so short ones leave many small ones",
    )

    for name, about in (
        ("silver", "attribute raw events into the row-level layer"),
        ("gold", "summarise the row-level layer"),
        ("daily", "both, with gates, for yesterday or the given raw dates"),
        ("compact", "rewrite recent days with fewer files"),
    ):
        job = jobs.add_parser(name, help=about)
        job.add_argument("--lake", required=True, help="root of the tables")
        if name in ("silver", "daily"):
            job.add_argument("--raw-base", required=True)
        if name in ("silver", "gold", "daily"):
            start = yesterday if name != "gold" else None
            job.add_argument("--run-date-start", type=date.fromisoformat, default=start)
            job.add_argument("--run-date-end", type=date.fromisoformat, default=yesterday)
        if name in ("silver", "gold"):
            job.add_argument("--full-refresh", action="store_true")
        if name == "silver":
            job.add_argument("--click-window-days", type=int, default=CLICK_DAYS)
            job.add_argument("--conversion-window-days", type=int, default=CONVERSION_DAYS)
        if name == "gold":
            job.add_argument("--trailing-days", type=int, help="recompute these, changed or not")
        if name == "compact":
            job.add_argument("--layer", choices=("silver", "gold"), default="silver")
            job.add_argument("--sort-by", help="sort files by this column")
            job.add_argument("--zorder-by", nargs="+", help="lay files along these columns together")

    shown = jobs.add_parser("report", help="print a report or gate")
    shown.add_argument("name", choices=sorted(reports.REPORTS))
    shown.add_argument("--lake", required=True, help="root of the tables")
    shown.add_argument("--as-of", type=date.fromisoformat, default=today)
    shown.add_argument("--rows", type=int, default=100, help="rows to print")
    return root


def parse(arguments: list[str] | None, today: date) -> argparse.Namespace:
    """Arguments with their rules checked; a wrong combination exits with a message."""
    root = parser(today)
    args = root.parse_args(arguments)
    start, end = getattr(args, "run_date_start", None), getattr(args, "run_date_end", None)
    if start and end and start > end:
        root.error(f"--run-date-start {start} is after --run-date-end {end}")
    if args.job == "gold" and args.full_refresh and not start:
        root.error("--full-refresh needs --run-date-start: it replaces the whole table")
    return args


def run_bronze(args: argparse.Namespace) -> None:
    spark = build_session("adlake-bronze")

    def open_topic(event_type: str):
        topic = getattr(args, f"topic_{event_type}")
        if args.servers:
            return read_kafka_topic(
                spark, topic, args.servers, args.starting_offsets, args.max_per_trigger
            )
        return read_file_topic(spark, topic, args.max_per_trigger)

    if args.lake:
        spark.streams.addListener(bronze.StreamLog(Lake(spark, args.lake)))
    queries = bronze.start_streams(
        spark,
        open_topic,
        args.raw_base,
        args.checkpoint_base,
        args.topic_type,
        {"processingTime": f"{args.trigger_seconds} seconds"},
    )
    bronze.run_streams(spark, queries)


def run_silver(lake: Lake, args: argparse.Namespace) -> None:
    windows = silver.Windows(args.click_window_days, args.conversion_window_days)
    run = silver.run_full_refresh if args.full_refresh else silver.run_incremental
    run(lake, args.raw_base, args.run_date_start, args.run_date_end, windows)


def run_gold(lake: Lake, args: argparse.Namespace, today: date) -> None:
    if args.full_refresh:
        gold.run_full_refresh(lake, args.run_date_start, args.run_date_end)
    elif args.run_date_start:
        gold.run_range(lake, args.run_date_start, args.run_date_end)
    elif args.trailing_days:
        gold.run_trailing(lake, today, args.trailing_days)
    else:
        gold.run_daily(lake)


def main(arguments: list[str] | None = None) -> None:
    now = datetime.now(timezone.utc)
    today = now.date()
    args = parse(arguments, today)
    if args.job == "bronze":
        return run_bronze(args)
    lake = Lake(build_session(f"adlake-{args.job}"), args.lake)
    if args.job == "silver":
        run_silver(lake, args)
    elif args.job == "gold":
        run_gold(lake, args, today)
    elif args.job == "daily":
        daily.run_range(lake, args.raw_base, now, args.run_date_start, args.run_date_end)
    elif args.job == "report":
        reports.report(lake, args.name, args.as_of).show(args.rows, truncate=False)
    elif args.zorder_by:
        maintenance.compact_zorder(lake, today, tuple(args.zorder_by), layer=args.layer)
    elif args.sort_by:
        maintenance.compact_sorted(lake, today, args.sort_by, layer=args.layer)
    else:
        maintenance.compact_binpack(lake, today, layer=args.layer)


if __name__ == "__main__":
    main()
