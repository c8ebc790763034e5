"""Row-level layer: raw events to one attributed row per impression."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlake.functions.columns import SECONDS_PER_DAY, clock
from adlake.operators.attribution import (
    CLICK_DAYS,
    CONVERSION_DAYS,
    Batch,
    attribute_all,
    batch_measures,
    candidates,
    first_day,
    match_events,
    observed_batch,
    silver_rows,
)
from adlake.operators.changes import day_summaries
from adlake.operators.dedup import ARRIVAL_ORDER, first_per_key
from adlake.operators.upsert import (
    apply_updates,
    delete_where,
    insert_absent,
    pending_updates,
    update_where,
)
from adlake.schemas import SILVER, keyed, nullable
from adlake.session import scratch
from adlake.sources.files import partition_values
from adlake.sources.raw import raw_days, read_raw
from adlake.sources.tables import Lake, balanced


class NothingMatched(RuntimeError):
    """Events arrived but not one of them found its impression."""


@dataclass(frozen=True)
class Windows:
    click_days: int = CLICK_DAYS
    conversion_days: int = CONVERSION_DAYS

    @property
    def click(self) -> int:
        return self.click_days * SECONDS_PER_DAY

    @property
    def conversion(self) -> int:
        return self.conversion_days * SECONDS_PER_DAY


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def run_incremental(
    lake: Lake,
    raw_base: str,
    start: date | str,
    end: date | str,
    windows: Windows = Windows(),
    now: datetime | None = None,
    require_match: bool = True,
) -> None:
    """Insert the impressions of the run dates, then attribute their clicks and conversions.

    Days that a run lost by dying within its commit are rebuilt first. The summaries of every
    day the batch concerns are renewed whether or not a row changed, so that a repeated run also
    repairs those of a run that died after its data was written.
    """
    rebuild_lost(lake, raw_base, end, windows, now)
    impressions, clicks, conversions = (
        keyed(read_raw(lake.spark, raw_base, kind, start, end))
        for kind in ("impression", "click", "conversion")
    )
    with scratch(lake.spark, "silver-run") as folder:
        shown, inserted = insert_impressions(lake, impressions, f"{folder}/impressions", now)
        updates = stage_updates(lake, clicks, conversions, windows, folder, require_match)
        apply_stored(lake, updates, now)
        lake.summarize(sorted({*shown, *updates.matched}))
    lake.record("silver", "incremental", inserted + updates.changes, now)


def rebuild_lost(
    lake: Lake, raw_base: str, end: date | str, windows: Windows, now: datetime | None
) -> None:
    """Rebuild days that have a summary and no folder from all raw events ingested by ``end``."""
    lost = lake.lost_days()
    if not lost:
        return
    first = min(raw_days(lake.spark, raw_base, "impression"), default=end)
    raw = [
        keyed(read_raw(lake.spark, raw_base, kind, first, end))
        for kind in ("impression", "click", "conversion")
    ]
    rows = silver_rows(attribute_all(*raw, windows.click, windows.conversion), clock(now))
    lake.append("silver", rows.where(F.col("event_date").isin(lost)))
    lake.summarize(lost)


def stored_days(lake: Lake, path: str) -> list[date]:
    """Days of a staged table, from its folder names."""
    return [date.fromisoformat(d) for d in partition_values(lake.spark, path, "event_date")]


def insert_impressions(
    lake: Lake, impressions: DataFrame, path: str, now: datetime | None = None
) -> tuple[list[date], int]:
    """Stage 1. Ids stored under any date are left alone, so the first stored row wins.

    Only days whose id filter is hit are opened, so a batch of new ids opens none. Returns the
    days of the batch and the number of rows that were new.
    """
    rows = silver_rows(first_per_key(impressions, ["eid"]), clock(now))
    ends = Observation()
    rows = rows.observe(
        ends,
        F.min("event_id").alias("first"),
        F.max("event_id").alias("last"),
        F.count(F.lit(1)).alias("count"),
    )
    balanced(rows, "event_date").write.partitionBy("event_date").parquet(path)
    days = stored_days(lake, path)
    if not days:
        return [], 0
    # Read again below; the kept copy spares further deduplications.
    staged = lake.spark.read.schema(nullable(SILVER)).parquet(path)
    found = ends.get
    fresh = absent_rows(lake, staged, found["first"], found["last"], found["count"])
    # Filters first: one that names ids which are not stored yet costs a look, no row.
    lake.note_ids(staged)
    return days, lake.append("silver", fresh, ids_noted=True, placed=fresh is staged)


def absent_rows(
    lake: Lake, staged: DataFrame, first: str, last: str, count: int | None = None
) -> DataFrame:
    """Staged rows whose id no stored day holds."""
    days = lake.days_holding(staged, count)
    if not days:
        return staged
    # Within the days hit, the id range lets the scan skip row groups of other ids.
    known = lake.read_days("silver", days).where(F.col("event_id").between(first, last))
    return insert_absent(known, staged, "event_id", count)


@dataclass(frozen=True)
class Updates:
    """Staged updates, one row per matched impression, and what is known about them."""

    rows: DataFrame
    matched: list[date]
    changed: list[date]
    changes: int


def stage_updates(
    lake: Lake,
    clicks: DataFrame,
    conversions: DataFrame,
    windows: Windows,
    folder: str,
    require_match: bool,
) -> Updates:
    """Stage 2. One row per stored impression the batch matches, written by its day.

    With ``require_match`` a batch that matches nothing fails before anything is changed. What
    the plan needs to know is observed while the batches are written, not queried afterwards.
    """
    matches, arrived = {}, {}
    for kind, events, window in (
        ("click", clicks, windows.click),
        ("conversion", conversions, windows.conversion),
    ):
        path, seen = f"{folder}/{kind}s", Observation()
        unique = first_per_key(events, ["eid"]).select("eid", "timestamp", *ARRIVAL_ORDER)
        unique.observe(seen, *batch_measures()).write.parquet(path)
        staged, batch = lake.spark.read.schema(unique.schema).parquet(path), observed_batch(seen.get)
        arrived[kind] = batch.events
        stored = reachable(lake, batch, window)
        matches[kind] = match_events(staged, stored, window, batch.events)
    path, seen = f"{folder}/updates", Observation()
    updates = pending_updates(matches["click"], matches["conversion"])
    changes = F.col("changes")
    updates = updates.observe(
        seen,
        F.count_if(F.col("new_click") == 1).alias("click"),
        F.count("new_conversion_timestamp").alias("conversion"),
        F.count_if(changes).alias("changes"),
        F.collect_set(F.when(changes, F.col("event_date"))).alias("changed"),
    )
    balanced(updates, "event_date").write.partitionBy("event_date").parquet(path)
    found = seen.get
    if require_match:
        for kind in arrived:
            require_matches(kind, arrived[kind], found[kind])
    staged = lake.spark.read.schema(updates.schema).parquet(path)
    return Updates(staged, stored_days(lake, path), sorted(found["changed"]), found["changes"])


def apply_stored(lake: Lake, updates: Updates, now: datetime | None = None) -> None:
    """Rewrite the days on which an update changes a row.

    Clicks and conversions are applied together, so a day is rewritten once; a repeated run
    rewrites none.
    """
    if updates.changed:
        touched = lake.read_days("silver", updates.changed)
        changes = updates.rows.where(F.col("changes"))
        rows = apply_updates(touched, changes, clock(now), updates.changes)
        lake.replace_days("silver", rows, updates.changed)


def reachable(lake: Lake, batch: Batch, window: int) -> DataFrame:
    """The stored impressions a batch can match, of the days and ids it can concern."""
    first = first_day(batch, window)
    days = [] if first is None else [day for day in lake.days("silver") if day >= first]
    return lake.read_days("silver", days).where(candidates(batch, window))


def require_matches(event_type: str, events: int, matched: int) -> None:
    """Fail when events arrived and none matched."""
    if matched == 0 and events:
        raise NothingMatched(
            f"{event_type} events arrived but none matched a stored impression; "
            "was the impression stage complete?"
        )


def refreshed(
    spark: SparkSession,
    raw_base: str,
    start: date | str,
    end: date | str,
    windows: Windows = Windows(),
    now: datetime | None = None,
) -> DataFrame:
    """The table rebuilt from raw impressions ingested in the range.

    Clicks and conversions are read beyond the end of the range by their window, since those
    of its last impressions may arrive that much later.
    """
    last = as_date(end)
    impressions = keyed(read_raw(spark, raw_base, "impression", start, last))
    clicks = keyed(
        read_raw(spark, raw_base, "click", start, last + timedelta(days=windows.click_days))
    )
    conversions = keyed(
        read_raw(
            spark, raw_base, "conversion", start, last + timedelta(days=windows.conversion_days)
        )
    )
    attributed = attribute_all(
        impressions, clicks, conversions, windows.click, windows.conversion
    )
    return silver_rows(attributed, clock(now))


def run_full_refresh(
    lake: Lake,
    raw_base: str,
    start: date | str,
    end: date | str,
    windows: Windows = Windows(),
    now: datetime | None = None,
) -> None:
    """Replace the whole table; days the range does not bring are dropped."""
    noted = {row[0] for row in lake.read("silver_days").select("event_date").collect()}
    before = {*noted, *lake.days("silver")}
    with scratch(lake.spark, "silver-refresh") as path:
        # Kept once, for the filters, the table and its summaries.
        rows = refreshed(lake.spark, raw_base, start, end, windows, now)
        balanced(rows, "event_date").write.partitionBy("event_date").parquet(path)
        staged = lake.spark.read.schema(nullable(SILVER)).parquet(path)
        lake.note_ids(staged)
        records = lake.replace_days("silver", staged, None)
        lake.note_days("silver_days", day_summaries(staged), before - set(stored_days(lake, path)))
    lake.record("silver", "refresh", records, now)


def update_stored(
    lake: Lake,
    predicate: Column,
    assignments: dict[str, Column],
    days: list[date] | None = None,
    now: datetime | None = None,
) -> None:
    """``UPDATE`` on the stored table, in the given days or all that hold such rows."""
    rewrite(lake, predicate, lambda rows: update_where(rows, predicate, assignments), days, now)


def delete_stored(
    lake: Lake, predicate: Column, days: list[date] | None = None, now: datetime | None = None
) -> None:
    """``DELETE`` on the stored table; a day whose last row goes is gone with it."""
    rewrite(lake, predicate, lambda rows: delete_where(rows, predicate), days, now)


def rewrite(lake: Lake, predicate: Column, change, days, now) -> None:
    rows = lake.read("silver") if days is None else lake.read_days("silver", days)
    # At most one row per day the table holds.
    hit = rows.where(predicate).groupBy("event_date").count().collect()
    touched = sorted(row["event_date"] for row in hit)
    if touched:
        changed = change(lake.read_days("silver", touched))
        changed = changed.withColumn("updated_at", clock(now))
        lake.replace_days("silver", changed, touched)
        lake.summarize(touched)
    lake.record("silver", "rewrite", sum(row["count"] for row in hit), now)
