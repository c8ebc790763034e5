"""Campaign KPIs per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import only_if, ratio


def campaign_kpis(silver: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per (day, campaign).

    The first step groups by user as well. That spreads a campaign holding a third of all
    rows over many tasks, and turns both distinct counts into plain counts, so rows are not
    expanded once per distinct. What remains for the second step combines before its shuffle.

    The KPI table requires a campaign; rows without one are reported by
    :func:`missing_campaigns`.
    """
    converted = F.col("conversion") == 1
    delay = only_if(F.col("conversion_delay_sec") >= 0, "conversion_delay_sec")
    per_user = (
        silver.where(F.col("campaign").isNotNull())
        .groupBy("event_date", "campaign", "uid")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("click").alias("clicks"),
            F.sum("conversion").alias("conversions"),
            F.sum("cost").alias("cost"),
            F.count_if((F.col("click") == 1) & converted).alias("through_click"),
            F.count_if((F.col("click") == 0) & converted).alias("through_view"),
            F.count_if(converted).alias("converted"),
            F.sum(delay).alias("delay_sum"),
            F.count(delay).alias("delay_count"),
        )
    )
    totals = per_user.groupBy("event_date", "campaign").agg(
        F.sum("rows").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.count("uid").alias("unique_users"),
        F.count(only_if(F.col("converted") > 0, "uid")).alias("converting_users"),
        # Rounded, so that rates do not show the order in which doubles were added.
        F.round(F.sum("cost"), 6).alias("total_cost"),
        F.sum("through_click").alias("click_through_conversions"),
        F.sum("through_view").alias("view_through_conversions"),
        F.sum("delay_sum").alias("delay_sum"),
        F.sum("delay_count").alias("delay_count"),
    )
    return totals.select(
        F.col("event_date").alias("summary_date"),
        "campaign",
        "impressions",
        "clicks",
        "conversions",
        "unique_users",
        "converting_users",
        "total_cost",
        ratio("clicks", "impressions", 100.0).alias("ctr"),
        ratio("conversions", "clicks", 100.0).alias("cvr"),
        ratio("total_cost", "clicks").alias("cpc"),
        ratio("total_cost", "conversions").alias("cpa"),
        ratio("total_cost", "impressions", 1000.0).alias("cpm"),
        "click_through_conversions",
        "view_through_conversions",
        ratio("delay_sum", "delay_count").alias("avg_conversion_delay_sec"),
        ratio("impressions", "unique_users").alias("frequency"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
    )


def missing_campaigns(silver: DataFrame) -> DataFrame:
    """Rows per day that the KPI table leaves out for want of a campaign."""
    return (
        silver.where(F.col("campaign").isNull())
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("rows_without_campaign"))
    )
