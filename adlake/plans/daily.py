"""The ordered daily run: raw data present, row-level layer, its gates, KPI layer, its gates."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from adlake.functions.columns import as_utc
from adlake.plans import checks, gold, maintenance, silver
from adlake.plans.silver import Windows, as_date
from adlake.sources.raw import raw_days
from adlake.sources.tables import Lake


def run(
    lake: Lake,
    raw_base: str,
    start: date | str,
    end: date | str,
    now: datetime,
    windows: Windows = Windows(),
    compact: bool = False,
    require_match: bool = True,
) -> None:
    """Process the raw dates ``start`` to ``end``; the first failing gate stops the run.

    ``now`` is the time of the run: its UTC date decides what counts as committed today. Each
    gate is one query for all run dates. Compaction comes after the last gate.
    """
    as_of, first, last = as_utc(now).date(), as_date(start), as_date(end)
    run_dates = [first + timedelta(days=n) for n in range((last - first).days + 1)]

    held = set(raw_days(lake.spark, raw_base, "impression"))
    missing = [day for day in run_dates if str(day) not in held]
    if missing:  # a folder exists when a file of the day does
        raise checks.UnhealthyData(f"bronze_present: nothing on {', '.join(map(str, missing))}")

    silver.run_incremental(lake, raw_base, start, end, windows, now, require_match)
    checks.gate(checks.no_commit_today(lake.log().coalesce(1), "silver", as_of), "silver_commit")
    # The run has just counted the days it concerns.
    stored = lake.read("silver_days").where(F.col("event_date").isin(run_dates))
    checks.gate(checks.dates_without_rows(stored, run_dates), "silver_rows")

    gold.run_daily(lake, now)
    checks.gate(checks.no_commit_today(lake.log().coalesce(1), "gold", as_of), "gold_commit")
    summed = lake.read_days("gold", run_dates)
    counted = stored.select(F.col("event_date").alias("run_date"), F.col("row_count").alias("silver_rows"))
    checks.gate(checks.counts_apart(counted, summed, run_dates), "consistency")

    if compact:
        maintenance.compact_binpack(lake, as_of, now=now)


def run_range(
    lake: Lake,
    raw_base: str,
    now: datetime,
    start: date | str | None = None,
    end: date | str | None = None,
    compact: bool = True,
) -> None:
    """The run for the given raw dates, yesterday without any."""
    yesterday = as_utc(now).date() - timedelta(days=1)
    run(lake, raw_base, start or end or yesterday, end or yesterday, now, compact=compact)
