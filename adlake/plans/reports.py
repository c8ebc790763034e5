"""The reports and gates by name, over the tables of a lake."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame

from adlake.operators import sketches
from adlake.plans import checks, maintenance
from adlake.plans.silver import as_date
from adlake.sources.tables import Lake

# Event times older than this are reported as strays.
STRAY_AFTER_DAYS = 400


def yesterday(as_of: date) -> date:
    return as_of - timedelta(days=1)


def freshness(lake: Lake, as_of: date) -> DataFrame:
    """Stale layers; of topics those whose streams keep a log."""
    streams = lake.read("stream_log")
    topics = sorted(r[0] for r in streams.select("topic").distinct().collect())
    layers = ("silver", "gold", *(f"bronze {topic}" for topic in topics))
    return checks.stale_layers(checks.with_streams(lake.log(), streams), as_of, layers)


REPORTS: dict[str, Callable[[Lake, date], DataFrame]] = {
    "freshness": lambda lake, at: freshness(lake, at),
    "consistency": lambda lake, at: checks.layer_mismatch(lake.read("silver"), lake.read("gold"), at),
    "missing-dates": lambda lake, at: checks.missing_days(lake.read("silver"), at),
    "latency": lambda lake, at: checks.slow_days(lake.read("silver"), at),
    "volume": lambda lake, at: checks.daily_volume(lake.read("silver"), at),
    "week-over-week": lambda lake, at: checks.week_over_week(lake.read("silver"), at),
    "attribution": lambda lake, at: checks.attribution_coverage(lake.read("silver"), at),
    "latency-trend": lambda lake, at: checks.latency_trend(lake.read("silver"), at),
    "kpi-trend": lambda lake, at: checks.kpi_trend(lake.read("gold"), at),
    "conversion-delay": lambda lake, at: checks.conversion_delays(lake.read("silver"), at),
    "day": lambda lake, at: checks.day_drilldown(lake.read_days("silver", [at]), at),
    "recent-runs": lambda lake, at: checks.recent_commits(lake.log()),
    "files": lambda lake, at: maintenance.report_files(lake),
    "runs": lambda lake, at: checks.runs(lake.log()),
    "retention": lambda lake, at: checks.commit_retention(lake.log()),
    "quality": lambda lake, at: checks.quality_profile(lake.read("silver")),
    "stray-days": lambda lake, at: checks.stray_days(lake.read("silver_days"), at, STRAY_AFTER_DAYS),
    "rate-drops": lambda lake, at: checks.rate_drops(lake.read("silver_days"), at),
    "users": lambda lake, at: sketches.users_window(lake.read("gold_sketches"), at),
    "delays": lambda lake, at: sketches.delays_window(lake.read("gold_sketches"), at),
    "streams": lambda lake, at: checks.stream_runs(lake.read("stream_log")),
    "gate-silver-run": lambda lake, at: checks.no_commit_today(lake.log(), "silver", at),
    "gate-gold-run": lambda lake, at: checks.no_commit_today(lake.log(), "gold", at),
    "gate-rows": lambda lake, at: checks.no_rows(
        lake.read_days("silver", [yesterday(at)]), yesterday(at)
    ),
    "gate-consistency": lambda lake, at: checks.run_mismatch(
        lake.read_days("silver", [yesterday(at)]),
        lake.read_days("gold", [yesterday(at)]),
        yesterday(at),
    ),
}


def report(lake: Lake, name: str, as_of: date | str) -> DataFrame:
    return REPORTS[name](lake, as_date(as_of))
