"""Day sketches of the KPI layer: distinct users and percentiles that add up over days.

Distinct counts and percentiles of a window cannot be had from those of its days. Sketches can be
merged, so a window of any length reads one small row per day and campaign instead of the
row-level table.

Theta sketches are exact up to 2^LG_USERS different users of a window and within about 1 % beyond;
two of them can be intersected, which counts users who came back. Quantile sketches are exact up
to about QUANTILE_K values and within 0.1 % of rank beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import day, only_if, trailing_days

LG_USERS = 14
QUANTILE_K = 4096
WINDOWS = (7, 14, 30)
SHARES = {"p25_sec": 0.25, "p50_sec": 0.5, "p75_sec": 0.75, "p90_sec": 0.9, "p95_sec": 0.95}


def day_sketches(silver: DataFrame) -> DataFrame:
    """One row per (day, campaign); combines before its shuffle, so no group meets in one task."""
    delay = only_if(F.col("conversion_delay_sec") >= 0, "conversion_delay_sec")
    return (
        silver.where(F.col("campaign").isNotNull())
        .groupBy(F.col("event_date").alias("summary_date"), "campaign")
        .agg(
            F.theta_sketch_agg("uid", LG_USERS).alias("users"),
            F.theta_sketch_agg(only_if(F.col("conversion") == 1, "uid"), LG_USERS).alias("converting_users"),
            F.kll_sketch_agg_bigint(only_if(F.col("conversion") == 1, delay), QUANTILE_K).alias(
                "conversion_delay_sec"
            ),
            F.kll_sketch_agg_bigint("end_to_end_latency_sec", QUANTILE_K).alias("end_to_end_latency_sec"),
        )
    )


def users_window(sketches: DataFrame, as_of, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Users per campaign of the last days, users with a conversion, and users who were there in
    the window before as well. One scan of the day rows serves all windows."""
    end, longest = day(as_of), max(windows)
    back = F.date_diff(end, F.col("summary_date"))
    spans = F.explode(F.array(*(F.lit(n) for n in windows))).alias("window_days")
    recent = sketches.where(trailing_days("summary_date", as_of, 2 * longest)).select(
        "campaign", "users", "converting_users", back.alias("back"), spans
    )
    now = F.col("back") <= F.col("window_days")
    before = (F.col("back") > F.col("window_days")) & (F.col("back") <= 2 * F.col("window_days"))
    merged = recent.groupBy("window_days", "campaign").agg(
        F.theta_union_agg(only_if(now, "users"), LG_USERS).alias("now"),
        F.theta_union_agg(only_if(now, "converting_users"), LG_USERS).alias("converting"),
        F.theta_union_agg(only_if(before, "users"), LG_USERS).alias("before"),
    )
    users = F.theta_sketch_estimate("now")
    return merged.select(
        "window_days",
        "campaign",
        users.alias("users"),
        F.theta_sketch_estimate("converting").alias("converting_users"),
        F.theta_sketch_estimate(F.theta_intersection("now", "before")).alias("returning_users"),
    ).where("users > 0")


def delays_window(sketches: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Percentiles of conversion delay and of ingestion latency over the last days."""
    metrics = ("conversion_delay_sec", "end_to_end_latency_sec")
    recent = sketches.where(trailing_days("summary_date", as_of, days))
    merged = recent.agg(*(F.kll_merge_agg_bigint(m, QUANTILE_K).alias(m) for m in metrics))
    rows = merged.select(F.explode(F.array(*(
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("sketch")) for m in metrics
    ))).alias("m")).select("m.*", F.kll_sketch_get_n_bigint("m.sketch").alias("n"))
    # An empty sketch has no quantiles.
    known = F.col("n") > 0
    at = F.when(known, F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, SHARES.values()))))
    return rows.withColumn("at", at).select(
        "metric", "n", *(F.col("at")[i].alias(name) for i, name in enumerate(SHARES))
    )
