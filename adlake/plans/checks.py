"""Health reports and gates.

Every check is a query over the tables for a given ``as_of`` date. A gate is healthy when it
returns no rows; :func:`gate` raises otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.columns import column, day, ratio, trailing_days

LATENCY_LIMIT_SEC = 300
MAX_DIFFERENCE = 0.1
SHOWN_ROWS = 20


class UnhealthyData(RuntimeError):
    """A gate returned rows."""


def gate(check: DataFrame, name: str) -> None:
    """Raise when the check returns anything, with its first rows in the message."""
    rows = check.limit(SHOWN_ROWS + 1).collect()
    if rows:
        shown = "; ".join(str(row.asDict()) for row in rows[:SHOWN_ROWS])
        more = f" and more, {check.count()} in all" if len(rows) > SHOWN_ROWS else ""
        raise UnhealthyData(f"{name}: {shown}{more}")


def percentile(name: str, share: float):
    """Approximate percentile; its sketch has a fixed size per group whatever the row count."""
    return F.approx_percentile(name, F.lit(share))


def percent(part, whole):
    return F.round(ratio(part, whole, 100.0), 4)


# Alerts


def stale_layers(
    run_log: DataFrame, as_of, layers: tuple[str, ...] = ("silver", "gold")
) -> DataFrame:
    """Layers without a commit on ``as_of``, including layers that never had one."""
    spark = run_log.sparkSession
    layers = spark.createDataFrame([(name,) for name in layers], "layer string")
    latest = run_log.groupBy("layer").agg(F.max("committed_at").alias("latest_committed_at"))
    stale = F.coalesce(F.to_date("latest_committed_at") < day(as_of), F.lit(True))
    return (
        layers.join(latest, "layer", "left")
        .where(stale)
        .select("layer", F.lit("no_snapshot_today").alias("alert_type"), "latest_committed_at")
    )


def with_streams(run_log: DataFrame, stream_log: DataFrame) -> DataFrame:
    """The run log with the topics' micro-batches as runs of layers such as ``bronze click``."""
    batches = stream_log.select(F.concat(F.lit("bronze "), "topic").alias("layer"), "committed_at")
    return run_log.select("layer", "committed_at").unionByName(batches)


def layer_mismatch(silver: DataFrame, gold: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Yesterday's rows against yesterday's summed impressions: missing, or over 10 % apart.

    A day without any row-level data gives no row; :func:`no_rows` reports that. ``days``
    looks further back than yesterday.
    """
    stored = (
        silver.where(trailing_days("event_date", as_of, days))
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("silver_rows"))
    )
    summed = (
        gold.where(trailing_days("summary_date", as_of, days))
        .groupBy("summary_date")
        .agg(F.sum("impressions").alias("summed"))
    )
    missing = F.col("summary_date").isNull()
    apart = ratio(F.abs(F.col("silver_rows") - F.col("summed")), "silver_rows")
    return (
        stored.join(summed, F.col("event_date") == F.col("summary_date"), "left")
        .where(missing | (apart > MAX_DIFFERENCE))
        .select(
            "event_date",
            "silver_rows",
            F.coalesce("summed", F.lit(0)).alias("gold_impressions"),
            F.when(missing, 100.0).otherwise(F.round(apart * 100, 2)).alias("diff_pct"),
            F.when(missing, "gold_partition_missing")
            .otherwise("silver_gold_count_mismatch")
            .alias("alert_type"),
        )
    )


def missing_days(silver: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Days of the trailing window that have no rows."""
    end = day(as_of)
    calendar = silver.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(end, days), F.date_sub(end, 1))).alias("missing_date")
    )
    present = (
        silver.where(trailing_days("event_date", as_of, days))
        .select(F.col("event_date").alias("missing_date"))
        .distinct()
    )
    return calendar.join(present, "missing_date", "left_anti").select(
        "missing_date", F.lit("event_date_missing_in_silver").alias("alert_type")
    )


def slow_days(silver: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Yesterday, when its median end-to-end latency is over five minutes.

    ``days`` looks further back than yesterday.
    """
    return (
        silver.where(trailing_days("event_date", as_of, days))
        .groupBy("event_date")
        .agg(percentile("end_to_end_latency_sec", 0.5).alias("p50_e2e_sec"))
        .where(F.col("p50_e2e_sec") > LATENCY_LIMIT_SEC)
        .withColumn("alert_type", F.lit("5min_latency_threshold_breached"))
    )


# Operations


def daily_volume(silver: DataFrame, as_of, days: int = 14) -> DataFrame:
    """Rows, clicks, conversions and distinct users per day.

    Grouped by user first: a plain distinct would place a whole day on one task.
    """
    per_user = (
        silver.where(trailing_days("event_date", as_of, days))
        .groupBy("event_date", "uid")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("click").alias("clicks"),
            F.sum("conversion").alias("conversions"),
        )
    )
    return (
        per_user.groupBy("event_date")
        .agg(
            F.sum("rows").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"),
            F.count("uid").alias("unique_users"),
        )
        .orderBy("event_date")
    )


def week_over_week(silver: DataFrame, as_of) -> DataFrame:
    """Rows per day of this week against the same weekday a week before, in percent.

    Both weeks come from one scan: the earlier days are counted under the date seven later.
    """
    end = day(as_of)
    this_week = F.col("event_date") >= F.date_sub(end, 7)
    counted = (
        silver.where(trailing_days("event_date", as_of, 14))
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    aligned = F.when(this_week, F.col("event_date")).otherwise(F.date_add("event_date", 7))
    change = (ratio("rows_this_week", "rows_prev_week") - 1) * 100
    return (
        counted.groupBy(aligned.alias("event_date"))
        .agg(
            F.max(F.when(this_week, F.col("rows"))).alias("rows_this_week"),
            F.max(F.when(~this_week, F.col("rows"))).alias("rows_prev_week"),
        )
        .where(F.col("rows_this_week").isNotNull())
        .withColumn("wow_change_pct", F.round(change, 2))
        .orderBy("event_date")
    )


def attribution_coverage(silver: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Share of impressions with a click or conversion, per day."""
    return (
        silver.where(trailing_days("event_date", as_of, days))
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("impressions"),
            F.sum("click").alias("clicks"),
            F.sum("conversion").alias("conversions"),
        )
        .withColumn("click_rate_pct", percent("clicks", "impressions"))
        .withColumn("conv_rate_pct", percent("conversions", "impressions"))
        .orderBy("event_date")
    )


def latency_trend(silver: DataFrame, as_of, days: int = 14) -> DataFrame:
    """Median of each latency stage per day."""
    return (
        silver.where(trailing_days("event_date", as_of, days))
        .groupBy("event_date")
        .agg(
            percentile("producer_to_broker_sec", 0.5).alias("p50_p2b_sec"),
            percentile("broker_to_ingest_sec", 0.5).alias("p50_b2i_sec"),
            percentile("end_to_end_latency_sec", 0.5).alias("p50_e2e_sec"),
        )
        .orderBy("event_date")
    )


# Business


def kpi_trend(gold: DataFrame, as_of, days: int = 30) -> DataFrame:
    """KPIs per day and campaign with rates rounded, latest day first."""
    rounded = {name: F.round(name, 4) for name in ("ctr", "cvr", "cpc", "cpa", "cpm", "frequency")}
    return (
        gold.where(trailing_days("summary_date", as_of, days))
        .drop("avg_conversion_delay_sec", "updated_at")
        .withColumns(rounded)
        .orderBy(F.desc("summary_date"), "campaign")
    )


def conversion_delays(silver: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Percentiles of the time from impression to conversion, from one sketch."""
    shares = (0.25, 0.5, 0.75, 0.9, 0.95)
    names = ("p25_sec", "p50_sec", "p75_sec", "p90_sec", "p95_sec")
    converted = silver.where(
        trailing_days("event_date", as_of, days)
        & (F.col("conversion") == 1)
        & (F.col("conversion_delay_sec") >= 0)
    )
    summary = converted.agg(
        F.approx_percentile("conversion_delay_sec", list(shares)).alias("p"),
        F.count(F.lit(1)).alias("conversion_count"),
    )
    return summary.select(
        *(F.col("p")[i].alias(name) for i, name in enumerate(names)), "conversion_count"
    )


# Alerts over several weeks

WEEKS_BACK = 4
MOST_MADS, LEAST_DROP = 3.0, 0.5


def rate_drops(days: DataFrame, as_of, back: int = 30) -> DataFrame:
    """Days of the last ``back`` whose click or conversion rate fell suddenly.

    A day is compared with the same weekday of the four weeks before it: it alerts when its rate
    is below their median by more than three median absolute deviations and by more than half.
    Days with fewer than two such weekdays are not judged. ``days`` are day summaries, so the
    frames run over one row per day; rates are per million rows, in whole numbers.
    """
    measures = ("clicks", "conversions")
    rated = days.where(trailing_days("event_date", as_of, back + 7 * WEEKS_BACK)).select(
        "event_date", "row_count", F.explode(F.array(*(
            F.struct(F.lit(name).alias("measure"), F.col(name).alias("events")) for name in measures
        ))).alias("m"),
    ).select("event_date", "row_count", "m.*")
    rate = F.floor(F.col("events") * 1_000_000 / F.col("row_count"))
    rated = rated.withColumn("rate_ppm", rate).withColumn("number", F.unix_date("event_date"))
    weekday = Window.partitionBy("measure", F.weekday("event_date")).orderBy("number")
    before = weekday.rangeBetween(-7 * WEEKS_BACK, -1)
    usual = F.col("usual_ppm")
    apart = F.transform("past", lambda rate: F.abs(rate - usual))
    judged = (
        rated.withColumn("past", F.collect_list("rate_ppm").over(before))
        .where(F.size("past") >= 2)
        .withColumn("usual_ppm", middle(F.col("past")))
        .withColumn("mad_ppm", middle(apart))
    )
    low = (F.col("rate_ppm") < usual - MOST_MADS * F.col("mad_ppm")) & (F.col("rate_ppm") < LEAST_DROP * usual)
    return judged.where(trailing_days("event_date", as_of, back) & low).select(
        "event_date", "measure", "rate_ppm", "usual_ppm", "mad_ppm", F.size("past").alias("weeks")
    )


def middle(values) -> Column:
    """The median of an array of at most a few whole numbers."""
    ordered, size = F.array_sort(values), F.size(values)
    return (F.get(ordered, ((size - 1) / 2).cast("int")) + F.get(ordered, (size / 2).cast("int"))) / 2


# Incidents


def day_drilldown(silver: DataFrame, run_date) -> DataFrame:
    """Volume, attribution and latency of one day."""
    return (
        silver.where(F.col("event_date") == day(run_date))
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("silver_rows"),
            F.sum("click").alias("attributed_clicks"),
            F.sum("conversion").alias("attributed_conversions"),
            F.round(F.avg("end_to_end_latency_sec"), 2).alias("avg_e2e_sec"),
            percentile("end_to_end_latency_sec", 0.5).alias("p50_e2e_sec"),
            percentile("end_to_end_latency_sec", 0.95).alias("p95_e2e_sec"),
        )
        .withColumn("click_rate_pct", percent("attributed_clicks", "silver_rows"))
        .withColumn("conv_rate_pct", percent("attributed_conversions", "silver_rows"))
    )


def recent_commits(run_log: DataFrame, rows: int = 20) -> DataFrame:
    """The latest commits of both layers."""
    return (
        run_log.where(F.col("layer").isin("silver", "gold"))
        .select("layer", "commit_id", "parent_id", "committed_at", "operation")
        .orderBy(F.desc("committed_at"), "layer", F.desc("commit_id"))
        .limit(rows)
    )


# Infrastructure


def runs(run_log: DataFrame) -> DataFrame:
    """Runs and the rows they added or changed, per layer."""
    return run_log.groupBy("layer").agg(
        F.count(F.lit(1)).alias("run_count"), F.sum("records").alias("records")
    )


def stray_days(silver_days: DataFrame, as_of, back: int) -> DataFrame:
    """Stored days more than ``back`` days before ``as_of``, or after it: event times that
    producers got wrong, most likely."""
    end = day(as_of)
    near = F.col("event_date").between(F.date_sub(end, back), F.date_add(end, 1))
    return silver_days.where(~near).select("event_date", "row_count")


def stream_runs(stream_log: DataFrame) -> DataFrame:
    """Micro-batches per topic, what they read and could not decode, and their longest lag."""
    return stream_log.groupBy("topic").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("rows"),
        F.sum("undecoded").alias("undecoded"),
        F.max("lag_sec").alias("max_lag_sec"),
    )


def commit_retention(run_log: DataFrame) -> DataFrame:
    """First and last commit per layer and the complete days between them."""
    return (
        run_log.groupBy("layer")
        .agg(
            F.count(F.lit(1)).alias("snapshot_count"),
            F.min("committed_at").alias("oldest_snapshot"),
            F.max("committed_at").alias("latest_snapshot"),
        )
        .withColumn(
            "retention_days",
            F.timestamp_diff("DAY", F.col("oldest_snapshot"), F.col("latest_snapshot")),
        )
    )


# Gates


def no_commit_today(run_log: DataFrame, layer: str, as_of) -> DataFrame:
    """A row when the layer's last commit is older than ``as_of`` or there is none."""
    latest = run_log.where(F.col("layer") == layer).agg(F.max("committed_at").alias("last"))
    stale = F.coalesce(F.to_date("last") < day(as_of), F.lit(True))
    return latest.where(stale).select(F.lit(f"{layer}_snapshot_missing").alias("alert"))


def no_rows(silver: DataFrame, run_date) -> DataFrame:
    """A row when the day has no rows. A global count exists even for an empty day."""
    counted = silver.where(F.col("event_date") == day(run_date)).agg(
        F.count(F.lit(1)).alias("silver_rows")
    )
    return counted.where(F.col("silver_rows") == 0)


def run_mismatch(silver: DataFrame, gold: DataFrame, run_date) -> DataFrame:
    """A row when the day's layers are over 10 % apart or the KPI layer has nothing.

    Both totals come from one aggregate over the two layers. It exists even when neither has
    rows, so an empty day is reported.
    """
    stored = silver.where(F.col("event_date") == day(run_date)).select(
        F.lit(1).alias("row"), F.lit(None).cast("bigint").alias("impressions")
    )
    summed = gold.where(F.col("summary_date") == day(run_date)).select(
        F.lit(None).cast("int").alias("row"), "impressions"
    )
    totals = stored.unionByName(summed).agg(
        F.count("row").alias("silver_rows"), F.sum("impressions").alias("summed")
    )
    missing = F.col("summed").isNull()
    apart = ratio(F.abs(F.col("silver_rows") - F.col("summed")), "silver_rows")
    return totals.where(missing | (apart > MAX_DIFFERENCE)).select(
        "silver_rows",
        F.coalesce("summed", F.lit(0)).alias("gold_impressions"),
        F.when(missing, 100.0).otherwise(F.round(apart * 100, 2)).alias("diff_pct"),
    )


def nothing_arrived(raw: DataFrame, run_date) -> DataFrame:
    """A row when no raw event was ingested on the day. Stops at the first event."""
    found = raw.where(F.col("raw_date") == day(run_date)).limit(1)
    return (
        found.agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") == 0)
        .select(day(run_date).alias("raw_date"), F.lit("bronze_missing").alias("alert"))
    )


def on_dates(spark, run_dates) -> DataFrame:
    """One row per run date."""
    return spark.createDataFrame([(value,) for value in run_dates], "run_date date")


def dates_without_raw(raw: DataFrame, run_dates) -> DataFrame:
    """The run dates on which no raw event was ingested."""
    held = raw.select(F.col("raw_date").alias("run_date"))
    missing = on_dates(raw.sparkSession, run_dates).join(held, "run_date", "left_anti")
    return missing.select("run_date", F.lit("bronze_missing").alias("alert"))


def dates_without_rows(silver: DataFrame, run_dates) -> DataFrame:
    """The run dates without rows in the row-level layer."""
    held = silver.select(F.col("event_date").alias("run_date"))
    missing = on_dates(silver.sparkSession, run_dates).join(held, "run_date", "left_anti")
    return missing.select("run_date", F.lit(0).alias("silver_rows"))


def dates_apart(silver: DataFrame, gold: DataFrame, run_dates) -> DataFrame:
    """:func:`run_mismatch` for several run dates in one query."""
    stored = silver.groupBy(F.col("event_date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("silver_rows")
    )
    return counts_apart(stored, gold, run_dates)


def counts_apart(stored: DataFrame, gold: DataFrame, run_dates) -> DataFrame:
    """:func:`dates_apart` from row counts (run_date, silver_rows) already at hand."""
    summed = gold.groupBy(F.col("summary_date").alias("run_date")).agg(
        F.sum("impressions").alias("summed")
    )
    totals = on_dates(gold.sparkSession, run_dates).join(stored, "run_date", "left")
    totals = totals.join(summed, "run_date", "left").withColumn(
        "silver_rows", F.coalesce("silver_rows", F.lit(0))
    )
    apart = ratio(F.abs(F.col("silver_rows") - F.col("summed")), "silver_rows")
    return totals.where(F.col("summed").isNull() | (apart > MAX_DIFFERENCE)).select(
        "run_date", "silver_rows", F.coalesce("summed", F.lit(0)).alias("gold_impressions")
    )


def quality_profile(silver: DataFrame) -> DataFrame:
    """Per day: share of NULL keys, flags outside 0 and 1, attribution rates.

    An addition the health queries above suggest; not one of them.
    """
    def outside(name):
        return F.count_if(~F.coalesce(column(name).isin(0, 1), F.lit(False)))

    def nulls(*names):
        any_null = F.lit(False)
        for name in names:
            any_null = any_null | F.col(name).isNull()
        return F.count_if(any_null)

    return (
        silver.groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            nulls("event_id", "uid").alias("null_keys"),
            nulls("campaign").alias("null_campaigns"),
            outside("click").alias("bad_click_flags"),
            outside("conversion").alias("bad_conversion_flags"),
            F.sum("click").alias("clicks"),
            F.sum("conversion").alias("conversions"),
        )
        .withColumn("click_rate_pct", percent("clicks", "rows"))
        .withColumn("conv_rate_pct", percent("conversions", "rows"))
    )
