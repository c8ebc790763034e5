"""KPI layer: campaign KPIs per day, kept up to date by recomputing changed days."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import clock, day
from adlake.operators.changes import changed_summaries
from adlake.operators.kpis import campaign_kpis
from adlake.operators.sketches import day_sketches
from adlake.operators.upsert import upsert
from adlake.plans.silver import as_date
from adlake.sources.tables import Lake

KEYS = ["summary_date", "campaign"]


def changed_days(lake: Lake) -> list[date]:
    """Days whose row-level content differs from what the KPI table was made of.

    Both sides are per-day summaries, so no table is scanned. Days the row-level table lost
    count as well, and so do days an earlier run left behind.
    """
    changed = changed_summaries(lake.read("gold_days"), lake.read("silver_days"))
    # One value per day of the table's calendar. Both tables of this layer hold the same days,
    # unless a dead run's commit lost one.
    lost = set(lake.days("gold")) ^ set(lake.days("gold_sketches"))
    return sorted({*(row[0] for row in changed.collect()), *lost})


def merge_days(lake: Lake, days: list[date], now: datetime | None = None) -> int:
    """Upsert the KPIs of the given days by (day, campaign) and log the run.

    Campaigns without rows keep theirs on days that still have rows; days without rows are
    dropped. What the days were made of is noted last.
    """
    records = 0
    if days:
        present = sorted(set(days) & set(lake.days("silver")))
        stored = lake.read_days("silver", present)
        made = campaign_kpis(stored, clock(now)), day_sketches(stored)
        for layer, fresh in zip(("gold_sketches", "gold"), reversed(made)):
            merged = upsert(lake.read_days(layer, present), fresh, KEYS, grouped=True)
            records = lake.replace_days(layer, merged, days)
        noted = lake.read("silver_days").where(F.col("event_date").isin(days))
        lake.note_days("gold_days", noted, set(days) - set(present))
    lake.record("gold", "merge", records, now)
    return records


def known_days(lake: Lake) -> list[date]:
    return sorted({*lake.days("silver"), *lake.days("gold")})


def run_daily(lake: Lake, now: datetime | None = None) -> int:
    """Recompute the days that changed since the last run."""
    return merge_days(lake, changed_days(lake), now)


def run_trailing(lake: Lake, as_of: date | str, days: int = 30, now: datetime | None = None) -> int:
    """Recompute the last ``days`` days without asking what changed."""
    end = as_date(as_of)
    recent = [d for d in known_days(lake) if end - timedelta(days=days) <= d < end]
    return merge_days(lake, recent, now)


def in_range(silver: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return silver.where(F.col("event_date").between(day(start), day(end)))


def run_range(
    lake: Lake, start: date | str, end: date | str, now: datetime | None = None
) -> int:
    """Recompute the given days, for backfills."""
    first, last = as_date(start), as_date(end)
    return merge_days(lake, [d for d in known_days(lake) if first <= d <= last], now)


def run_full_refresh(
    lake: Lake, start: date | str, end: date | str, now: datetime | None = None
) -> int:
    """Replace the whole table by the KPIs of the given days.

    The range is required: replacing by just the days that changed would lose all others.
    """
    if start is None or end is None or as_date(start) > as_date(end):
        raise ValueError("a full refresh needs a start date no later than its end date")
    first, last = as_date(start), as_date(end)
    before = {row[0] for row in lake.read("gold_days").select("event_date").collect()}
    days = [d for d in lake.days("silver") if first <= d <= last]
    stored = lake.read_days("silver", days)
    lake.replace_days("gold_sketches", day_sketches(stored), None)
    records = lake.replace_days("gold", campaign_kpis(stored, clock(now)), None)
    noted = lake.read("silver_days").where(F.col("event_date").isin(days))
    lake.note_days("gold_days", noted, before - set(days))
    lake.record("gold", "refresh", records, now)
    return records
