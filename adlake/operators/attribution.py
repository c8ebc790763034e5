"""Attribution of clicks and conversions to impressions.

An event belongs to the impression with the same id when it happens no earlier than the
impression and no later than the window. Events outside are dropped by design.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import (
    SECONDS_PER_DAY,
    elapsed,
    flag,
    instant,
    utc_day,
    within,
)
from adlake.operators.dedup import first_per_key
from adlake.operators.joins import batch_side

CLICK_DAYS = 7
CONVERSION_DAYS = 30
CLICK_WINDOW = CLICK_DAYS * SECONDS_PER_DAY
CONVERSION_WINDOW = CONVERSION_DAYS * SECONDS_PER_DAY

# Value of conversion columns on rows without a conversion.
NO_CONVERSION = -1


def attribute_all(
    impressions: DataFrame,
    clicks: DataFrame,
    conversions: DataFrame,
    click_window: int = CLICK_WINDOW,
    conversion_window: int = CONVERSION_WINDOW,
) -> DataFrame:
    """Every impression once, with ``click_ts`` and ``conv_ts`` where one falls in its window.

    Each side is deduplicated before the windows are tested, so a join key matches at most
    one row per side. Deduplication already places rows by ``eid`` and sorts them, and both
    joins reuse that: three shuffles in all.
    """
    shown = first_per_key(impressions, ["eid"])
    clicked = first_per_key(clicks, ["eid"]).select(
        F.col("eid").alias("click_eid"), F.col("timestamp").alias("click_ts")
    )
    converted = first_per_key(conversions, ["eid"]).select(
        F.col("eid").alias("conv_eid"), F.col("timestamp").alias("conv_ts")
    )
    in_click_window = (F.col("eid") == F.col("click_eid")) & within(
        "click_ts", "timestamp", click_window
    )
    in_conversion_window = (F.col("eid") == F.col("conv_eid")) & within(
        "conv_ts", "timestamp", conversion_window
    )
    return (
        shown.join(clicked, in_click_window, "left")
        .join(converted, in_conversion_window, "left")
        .drop("click_eid", "conv_eid")
    )


def silver_rows(impressions: DataFrame, now: Column | None = None) -> DataFrame:
    """Deduplicated impressions in the shape of the row-level table.

    ``click_ts`` and ``conv_ts`` are used when the input has them; without them a row starts
    out unattributed.
    """
    known = set(impressions.columns)
    absent = F.lit(None).cast("bigint")
    click_ts = F.col("click_ts") if "click_ts" in known else absent
    conv_ts = F.col("conv_ts") if "conv_ts" in known else absent
    seen = instant("timestamp")
    none = F.lit(NO_CONVERSION).cast("bigint")
    return impressions.select(
        F.col("eid").alias("event_id"),
        F.to_date(seen).alias("event_date"),
        F.hour(seen).alias("event_hour"),
        F.try_to_timestamp("event_time").alias("event_time"),
        "uid",
        "campaign",
        flag(click_ts.isNotNull()).alias("click"),
        flag(conv_ts.isNotNull()).alias("conversion"),
        F.coalesce(conv_ts, none).alias("conversion_timestamp"),
        F.coalesce(conv_ts - F.col("timestamp"), none).alias("conversion_delay_sec"),
        F.coalesce("cost", F.lit(0.0)).alias("cost"),
        elapsed("kafka_timestamp", "timestamp").alias("producer_to_broker_sec"),
        elapsed("ingest_ts", "kafka_timestamp").alias("broker_to_ingest_sec"),
        elapsed("ingest_ts", "timestamp").alias("end_to_end_latency_sec"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
    )


def match_events(
    events: DataFrame, silver: DataFrame, window: int, count: int | None = None
) -> DataFrame:
    """Deduplicated events joined to the stored impressions whose window they fall in.

    Returns the impression's key and flags with ``match_ts`` and ``match_delay_sec``. The
    window is measured from the stored ``event_time``, so a row without one never matches.
    ``count`` is the number of events, where it is known.
    """
    arrived = first_per_key(events, ["eid"]).select(
        F.col("eid").alias("match_eid"), F.col("timestamp").alias("match_ts")
    )
    stored = silver.select("event_id", "event_date", "event_time", "click", "conversion")
    belongs = (F.col("match_eid") == F.col("event_id")) & within("match_ts", "event_time", window)
    # The stored date comes from another field than event_time and the two may disagree; the
    # day is bounded from below only.
    not_before = F.col("event_date") >= utc_day(F.col("match_ts") - F.lit(window))
    return batch_side(arrived, count).join(stored, belongs & not_before, "inner").select(
        "event_id",
        "event_date",
        "click",
        "conversion",
        "match_ts",
        elapsed("match_ts", "event_time").alias("match_delay_sec"),
    )


@dataclass(frozen=True)
class Batch:
    """What the scan of stored impressions needs to know about a batch of events."""

    earliest: date | None
    first_key: str | None
    last_key: str | None
    events: int = 0


def batch_measures() -> list[Column]:
    """Aggregates that describe a batch; also to be observed while it is written."""
    return [
        utc_day(F.min("timestamp")).alias("earliest"),
        F.min("eid").alias("first"),
        F.max("eid").alias("last"),
        F.count(F.lit(1)).alias("events"),
    ]


def observed_batch(found) -> Batch:
    return Batch(found["earliest"], found["first"], found["last"], found["events"])


def describe_batch(events: DataFrame) -> Batch:
    """The first day and the key range of a batch, in one pass."""
    return observed_batch(events.agg(*batch_measures()).first())


def first_day(batch: Batch, window: int) -> date | None:
    """The first day whose impressions a batch can match; None for an empty batch."""
    if batch.earliest is None:
        return None
    days = -(-window // SECONDS_PER_DAY)
    reach = batch.earliest.toordinal() - days
    return date.fromordinal(max(reach, date.min.toordinal()))


def candidates(batch: Batch, window: int) -> Column:
    """A literal filter that keeps every stored impression a batch can match.

    A condition that compares the partition column with a column of the other join side does
    not prune files; literals do. One rule for every batch: no day before the window of its
    earliest event, and its key range. There is no last day, since the stored day may lie after
    the impression's own time.

    The key range reaches the Parquet scan as well: where ids grow with time, or days are
    compacted in id order, row groups outside it are skipped.
    """
    first = first_day(batch, window)
    if first is None:
        return F.lit(False)
    in_range = F.col("event_id").between(batch.first_key, batch.last_key)
    return (F.col("event_date") >= F.lit(first)) & in_range


def unmatched_alert(event_type: str, arrived: DataFrame, matched: DataFrame) -> DataFrame:
    """One row when events arrived but none of them found an impression, else none.

    Any match passes: a low share is normal, none at all points at a missing first stage.
    """
    # One aggregate over both sides, told apart by a flag; no join is involved.
    labelled = arrived.select(F.lit(0).alias("hit")).unionByName(
        matched.select(F.lit(1).alias("hit"))
    )
    totals = labelled.agg(
        F.count_if(F.col("hit") == 0).alias("source_events"),
        F.count_if(F.col("hit") == 1).alias("matched_events"),
    )
    return totals.where((F.col("source_events") > 0) & (F.col("matched_events") == 0)).select(
        F.lit(event_type).alias("event_type"), "source_events", "matched_events"
    )
