"""Which days of the row-level table changed between two states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import day, trailing_days

SUMMARY_COLUMNS = ("row_count", "clicks", "conversions", "last_update")


def day_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


def day_summaries(silver: DataFrame) -> DataFrame:
    """One row per day: enough to tell whether the day changed. Combines before its shuffle."""
    return silver.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("click").alias("clicks"),
        F.sum("conversion").alias("conversions"),
        F.max("updated_at").alias("last_update"),
    )


def changed_by_count(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Days whose row count differs from the earlier state or that are new in it.

    This rule overlooks rows updated in place and days that vanished; use
    :func:`changed_by_content` to see them. Without an earlier state every day counts.
    """
    if before is None:
        return after.select("event_date").distinct()
    earlier = day_counts(before).withColumnRenamed("row_count", "earlier_count")
    return (
        day_counts(after)
        .join(earlier, "event_date", "left")
        .where(~F.col("row_count").eqNullSafe(F.col("earlier_count")))
        .select("event_date")
    )


def changed_by_content(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Days that differ in rows, clicks, conversions or last write, on either side."""
    if before is None:
        return after.select("event_date").distinct()
    return changed_summaries(day_summaries(before), day_summaries(after))


def changed_summaries(before: DataFrame, after: DataFrame) -> DataFrame:
    """:func:`changed_by_content` on summaries already at hand, so no table is scanned."""
    earlier = before.select(
        F.col("event_date").alias("_day"),
        *(F.col(name).alias(f"_{name}") for name in SUMMARY_COLUMNS),
    )
    joined = after.join(earlier, F.col("event_date") == F.col("_day"), "full_outer")
    same = F.lit(True)
    for name in SUMMARY_COLUMNS:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return joined.where(~same).select(F.coalesce("event_date", "_day").alias("event_date"))


def first_commit_of_day(run_log: DataFrame, as_of, layer: str = "silver") -> DataFrame:
    """The first commit of the day; its parent is the state before all of the day's commits."""
    begins = day(as_of).cast("timestamp")
    return (
        run_log.where((F.col("layer") == layer) & (F.col("committed_at") >= begins))
        .orderBy("committed_at", "commit_id")
        .limit(1)
        .select("commit_id", "parent_id", "committed_at")
    )


def trailing_window(silver: DataFrame, as_of, days: int = 30) -> DataFrame:
    """The rows of the last ``days`` days: recomputing all of them needs no change detection."""
    return silver.where(trailing_days("event_date", as_of, days))


def restrict_to_days(silver: DataFrame, days: list) -> DataFrame:
    """Rows of the listed days. Literal days prune partitions, a join would not."""
    return silver.where(F.col("event_date").isin(sorted(days)) if days else F.lit(False))
