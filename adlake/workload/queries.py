"""One registered query per operator, over the test tables.

``events`` supplies impressions, clicks and conversions; ``orders`` and ``lineitem`` the join
with many distinct ids. Reports are taken as of the day after the last event. Table states are
returned without ``updated_at``, and doubles rounded, since both depend on the run.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import schemas
from adlake.functions.columns import clock, instant
from adlake.operators import attribution, changes, kpis, sketches, upsert, wide
from adlake.operators.dedup import first_per_key
from adlake.plans import checks, daily, gold, maintenance, silver
from adlake.session import session_path, use_utc
from adlake.sources import fixtures
from adlake.sources.id_buckets import IdBuckets
from adlake.sources.raw import append_raw, raw_days, raw_path, read_raw
from adlake.sources.tables import Lake, read_or_empty, time_function
from adlake.sources.topics import read_file_topic
from adlake.streaming import bronze

AS_OF = date(2024, 1, 31)
LATER = date(2024, 2, 10)
LAST = date(2024, 1, 31)
# The earlier of two table states holds what was ingested up to this day.
CUT = date(2024, 1, 15)
# Incremental batches that the raw dates are cut into.
BATCHES = 4
# A backfill of all raw dates but the last few, then one daily run for each of those.
DAILY_RUNS = 3
RANGE = (date(2024, 1, 10), date(2024, 1, 16))
REFRESH_RANGE = (date(2024, 1, 5), date(2024, 1, 20))
# Buckets of impressions stored by id.
ID_BUCKETS = 8
REAL_START, SPEED = 1704067200, 100


def now_column():
    return clock(datetime(2024, 1, 31, 2))


def tidy(df: DataFrame) -> DataFrame:
    """Without ``updated_at``; doubles to six places, so the order of a sum does not show."""
    return df.select(
        *(
            F.round(f.name, 6).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name)
            for f in df.schema
            if f.name != "updated_at"
        )
    )


def raw(spark: SparkSession, sf_dir: str, event_type: str, until: date | None = None) -> DataFrame:
    events = fixtures.raw_events(spark, sf_dir, event_type)
    return events if until is None else events.where(F.col("raw_date") <= F.lit(until))


def raws(spark: SparkSession, sf_dir: str, until: date | None = None) -> list[DataFrame]:
    """Events of all types that carry their keys; undecodable ones would share a null id."""
    types = schemas.EVENT_TYPES
    return [schemas.keyed(raw(spark, sf_dir, event_type, until)) for event_type in types]


def all_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, clicked, converted = raws(spark, sf_dir)
    return shown.unionByName(clicked, True).unionByName(converted, True)


def stage1(spark: SparkSession, sf_dir: str, until: date | None = None) -> DataFrame:
    shown = first_per_key(raws(spark, sf_dir, until)[0], ["eid"])
    return attribution.silver_rows(shown, now_column())


def full(spark: SparkSession, sf_dir: str, until: date | None = None) -> DataFrame:
    attributed = attribution.attribute_all(*raws(spark, sf_dir, until))
    return attribution.silver_rows(attributed, now_column())


def full_gold(spark: SparkSession, sf_dir: str, until: date | None = None) -> DataFrame:
    return kpis.campaign_kpis(full(spark, sf_dir, until), now_column())


# Stored raw layers, written once per session and input.
_stored_raw: dict[tuple[str, str], str] = {}


def stored_raw(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored_raw:
        base, tasks = session_path(spark, "raw"), spark.sparkContext.defaultParallelism
        for event_type in schemas.EVENT_TYPES:
            append_raw(raw(spark, sf_dir, event_type), base, event_type, tasks)
        _stored_raw[key] = base
    return _stored_raw[key]


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, session_path(spark, "lake"))


def run_time(raw_date: date) -> datetime:
    """Two in the morning after the last raw date of a run."""
    return datetime.combine(raw_date + timedelta(days=1), datetime.min.time().replace(hour=2))


# Lakes after the incremental batches, each followed by a KPI run; one per session and input.
_logged: dict[tuple[str, str], Lake] = {}


def logged_lake(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _logged:
        lake, base = new_lake(spark), stored_raw(spark, sf_dir)
        for start, end in batches(*raw_dates(spark, sf_dir)):
            now = run_time(end)
            due = something_matches(spark, sf_dir, start, end)
            silver.run_incremental(lake, base, start, end, now=now, require_match=due)
            gold.run_daily(lake, now)
        _logged[key] = lake
    return _logged[key]


def something_matches(spark: SparkSession, sf_dir: str, start: date, end: date) -> bool:
    """Whether the dates have a click and a conversion of an impression ingested by their end, so
    that the run must find one. A small table may have none of a kind in a batch."""
    shown = stage1(spark, sf_dir, end)
    arrived = F.col("raw_date").between(F.lit(start), F.lit(end))
    return not any(
        attribution.match_events(schemas.keyed(raw(spark, sf_dir, kind)).where(arrived), shown, window).isEmpty()
        for kind, window in (
            ("click", attribution.CLICK_WINDOW),
            ("conversion", attribution.CONVERSION_WINDOW),
        )
    )


def raw_dates(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last date on which anything was ingested, from the raw layer's folders."""
    base = stored_raw(spark, sf_dir)
    held = {d for event_type in schemas.EVENT_TYPES for d in raw_days(spark, base, event_type)}
    return date.fromisoformat(min(held)), date.fromisoformat(max(held))


def batches(first: date, last: date) -> list[tuple[date, date]]:
    """The dates in runs of about equal length, as far as there are enough of them."""
    span = (last - first).days + 1
    ends = [-(-span * n // BATCHES) for n in range(BATCHES + 1)]
    return [
        (first + timedelta(days=a), first + timedelta(days=b - 1))
        for a, b in zip(ends, ends[1:])
        if a < b
    ]


# Raw layer


def bronze_parse_all(spark, sf_dir):
    """Messages of all topics decoded; one in 97 is damaged first."""
    parsed = []
    for event_type in schemas.EVENT_TYPES:
        sent = fixtures.topic_messages(spark, sf_dir, event_type)
        damaged = F.when(F.col("offset") % 97 == 0, F.concat(F.lit("x"), "value"))
        sent = sent.withColumn("value", F.coalesce(damaged, F.col("value")))
        arrival = instant(F.unix_timestamp("timestamp") + (F.col("offset") * 37) % 601)
        parsed.append(bronze.parse_topic(sent, event_type, arrival))
    shown, clicked, converted = parsed
    return shown.unionByName(clicked, True).unionByName(converted, True)


def bronze_parse(spark, sf_dir):
    return schemas.keyed(bronze_parse_all(spark, sf_dir))


def bronze_quarantine(spark, sf_dir):
    return schemas.quarantined(bronze_parse_all(spark, sf_dir)).select(
        "kafka_partition", "kafka_offset", "kafka_timestamp", "ingest_ts", "raw_date", "raw_hour"
    )


def bronze_stream(spark, sf_dir):
    """All topics through the streams, read back without the wall-clock columns."""
    topics, base = session_path(spark, "topics"), session_path(spark, "streamed")
    for event_type in schemas.EVENT_TYPES:
        fixtures.topic_messages(spark, sf_dir, event_type).write.json(f"{topics}/{event_type}")
    running = bronze.start_streams(
        spark,
        lambda event_type: read_file_topic(spark, f"{topics}/{event_type}"),
        base,
        session_path(spark, "checkpoints"),
        trigger={"availableNow": True},
    )
    for query in running.values():
        query.awaitTermination()
    streamed = [
        read_or_empty(spark, raw_path(base, t), schemas.RAW[t]) for t in schemas.EVENT_TYPES
    ]
    shown, clicked, converted = streamed
    return (
        shown.unionByName(clicked, True)
        .unionByName(converted, True)
        .drop("ingest_ts", "raw_date", "raw_hour")
    )


def bronze_runs(spark, sf_dir):
    """What the streams' listener noted, with fixed times of ingestion; one message in 97 is
    damaged."""
    topics, lake = session_path(spark, "topics"), new_lake(spark)
    for event_type in schemas.EVENT_TYPES:
        sent = fixtures.topic_messages(spark, sf_dir, event_type)
        damaged = F.when(F.col("offset") % 97 == 0, F.concat(F.lit("x"), "value"))
        sent = sent.withColumn("value", F.coalesce(damaged, F.col("value")))
        sent.coalesce(1).write.json(f"{topics}/{event_type}")
    noted = bronze.StreamLog(lake)
    spark.streams.addListener(noted)
    try:
        running = bronze.start_streams(
            spark,
            lambda event_type: read_file_topic(spark, f"{topics}/{event_type}"),
            session_path(spark, "streamed"),
            session_path(spark, "checkpoints"),
            trigger={"availableNow": True},
            ingest_ts=instant(F.unix_timestamp("timestamp") + (F.col("offset") * 37) % 601),
        )
        for query in running.values():
            query.awaitTermination()
            noted.wait(query)
    finally:
        spark.streams.removeListener(noted)
    return checks.stream_runs(lake.read("stream_log"))


def raw_range_scan(spark, sf_dir):
    base = stored_raw(spark, sf_dir)
    shown, clicked, converted = (
        read_raw(spark, base, event_type, *RANGE) for event_type in schemas.EVENT_TYPES
    )
    return shown.unionByName(clicked, True).unionByName(converted, True)


def dedup_events(spark, sf_dir):
    return first_per_key(all_raw(spark, sf_dir), ["event_type", "eid"]).select(
        "event_type", "eid", "timestamp", "kafka_offset", "ingest_ts"
    )


# Attribution


def attribution_full(spark, sf_dir):
    return attribution.attribute_all(*raws(spark, sf_dir)).select(
        "eid", "uid", "timestamp", "click_ts", "conv_ts"
    )


def _matches(spark, sf_dir, event_type, window):
    events, stored = schemas.keyed(raw(spark, sf_dir, event_type)), stage1(spark, sf_dir)
    near = attribution.candidates(attribution.describe_batch(events), window)
    return attribution.match_events(events, stored.where(near), window)


def attribution_clicks(spark, sf_dir):
    return _matches(spark, sf_dir, "click", attribution.CLICK_WINDOW)


def attribution_conversions(spark, sf_dir):
    return _matches(spark, sf_dir, "conversion", attribution.CONVERSION_WINDOW)


def attribution_bucketed(spark, sf_dir):
    """All clicks and conversions against impressions stored in buckets of their id."""
    stored = IdBuckets(spark, session_path(spark, "id-buckets"), ID_BUCKETS)
    stored.append(stage1(spark, sf_dir))
    found = [
        stored.match(schemas.keyed(raw(spark, sf_dir, kind)), window).withColumn("event_type", F.lit(kind))
        for kind, window in (
            ("click", attribution.CLICK_WINDOW),
            ("conversion", attribution.CONVERSION_WINDOW),
        )
    ]
    stored.close()
    return found[0].unionByName(found[1])


def attribution_orders(spark, sf_dir):
    """Orders with the first line item shipped, where that is within 7 or 30 days."""
    shipped = fixtures.line_item_events(spark, sf_dir)
    return (
        attribution.attribute_all(fixtures.order_impressions(spark, sf_dir), shipped, shipped)
        .where(F.col("click_ts").isNotNull() | F.col("conv_ts").isNotNull())
        .select("eid", "uid", "timestamp", "click_ts", "conv_ts")
    )


def silver_stage1(spark, sf_dir):
    return tidy(stage1(spark, sf_dir))


def silver_conform(spark, sf_dir):
    shuffled = full(spark, sf_dir)
    return tidy(schemas.conform(shuffled.select(*reversed(shuffled.columns)), schemas.SILVER))


def silver_incremental(spark, sf_dir):
    return tidy(logged_lake(spark, sf_dir).read("silver"))


def _refreshed(spark, sf_dir, start, end):
    lake, base = new_lake(spark), stored_raw(spark, sf_dir)
    silver.run_full_refresh(lake, base, start, end, now=run_time(LAST))
    return tidy(lake.read("silver"))


def silver_full_refresh(spark, sf_dir):
    return _refreshed(spark, sf_dir, *raw_dates(spark, sf_dir))


def silver_refresh_range(spark, sf_dir):
    return _refreshed(spark, sf_dir, *REFRESH_RANGE)


def assert_matched(spark, sf_dir):
    """Clicks and conversions moved to before every impression, so none can match."""
    stored = stage1(spark, sf_dir)
    alerts = []
    for event_type, window in (
        ("click", attribution.CLICK_WINDOW),
        ("conversion", attribution.CONVERSION_WINDOW),
    ):
        events = raw(spark, sf_dir, event_type)
        early = events.withColumn("timestamp", F.col("timestamp") - 90 * 86400)
        matched = attribution.match_events(early, stored, window)
        alerts.append(attribution.unmatched_alert(event_type, early, matched))
    return alerts[0].unionByName(alerts[1])


# Upserts


def upsert_insert_absent(spark, sf_dir):
    target = stage1(spark, sf_dir, CUT)
    fresh = upsert.insert_absent(target, stage1(spark, sf_dir), "event_id")
    return tidy(target.unionByName(fresh))


def _updated(target, clicks, conversions):
    """The table after the pipeline's own update of matched clicks and conversions."""
    none = attribution.match_events(fixtures.no_events(target.sparkSession), target, 0)
    updates = upsert.pending_updates(
        none if clicks is None else attribution.match_events(clicks, target, attribution.CLICK_WINDOW),
        none
        if conversions is None
        else attribution.match_events(conversions, target, attribution.CONVERSION_WINDOW),
    )
    return tidy(upsert.apply_updates(target, updates, now_column()))


def upsert_click(spark, sf_dir):
    return _updated(stage1(spark, sf_dir), schemas.keyed(raw(spark, sf_dir, "click")), None)


def upsert_conversion(spark, sf_dir):
    """Applied to a table that already holds the earlier conversions, which must stay."""
    late = schemas.keyed(raw(spark, sf_dir, "conversion"))
    return _updated(full(spark, sf_dir, CUT), None, late)


def upsert_gold(spark, sf_dir):
    recent = full(spark, sf_dir).where(F.col("event_date") >= F.lit(RANGE[0]))
    staged = kpis.campaign_kpis(recent, now_column())
    return tidy(upsert.upsert(full_gold(spark, sf_dir, CUT), staged, gold.KEYS))


def _stored_full(spark, sf_dir) -> Lake:
    lake, base = new_lake(spark), stored_raw(spark, sf_dir)
    silver.run_full_refresh(lake, base, *raw_dates(spark, sf_dir), now=run_time(LAST))
    return lake


def update_where(spark, sf_dir):
    """One campaign's cost changed in the stored table."""
    lake = _stored_full(spark, sf_dir)
    silver.update_stored(lake, F.col("campaign") == 3, {"cost": F.col("cost") * 1.1})
    return tidy(lake.read("silver"))


def delete_where(spark, sf_dir):
    """One campaign and one whole day deleted from the stored table."""
    lake = _stored_full(spark, sf_dir)
    gone = (F.col("campaign") == 3) | (F.col("event_date") == F.lit(CUT))
    silver.delete_stored(lake, gone)
    return tidy(lake.read("silver"))


# KPIs and change detection


def gold_kpi(spark, sf_dir):
    return tidy(full_gold(spark, sf_dir))


def changed_dates_count(spark, sf_dir):
    return changes.changed_by_count(full(spark, sf_dir, CUT), full(spark, sf_dir))


def changed_dates_initial(spark, sf_dir):
    return changes.changed_by_count(None, full(spark, sf_dir))


def changed_dates_content(spark, sf_dir):
    return changes.changed_by_content(full(spark, sf_dir, CUT), full(spark, sf_dir))


def gold_changed_only(spark, sf_dir):
    days = [row[0] for row in changed_dates_content(spark, sf_dir).collect()]
    rows = changes.restrict_to_days(full(spark, sf_dir), days)
    return tidy(kpis.campaign_kpis(rows, now_column()))


def gold_trailing_window(spark, sf_dir):
    return tidy(kpis.campaign_kpis(changes.trailing_window(full(spark, sf_dir), AS_OF, 30)))


def gold_range(spark, sf_dir):
    return tidy(kpis.campaign_kpis(gold.in_range(full(spark, sf_dir), *RANGE)))


def gold_daily(spark, sf_dir):
    """The KPI table kept up to date batch by batch from the days each batch changed."""
    return tidy(logged_lake(spark, sf_dir).read("gold"))


def gold_full_refresh(spark, sf_dir):
    lake, dates, now = new_lake(spark), raw_dates(spark, sf_dir), run_time(LAST)
    silver.run_full_refresh(lake, stored_raw(spark, sf_dir), *dates, now=now)
    gold.run_full_refresh(lake, *dates, now)
    return tidy(lake.read("gold"))


def first_commit_of_day(spark, sf_dir):
    """Of the day after the second batch's last raw date."""
    second = batches(*raw_dates(spark, sf_dir))[1][1]
    return changes.first_commit_of_day(logged_lake(spark, sf_dir).log(), second + timedelta(days=1))


def users_window(spark, sf_dir):
    """Distinct users of 7, 14 and 30 days from the day sketches of the KPI layer."""
    return sketches.users_window(logged_lake(spark, sf_dir).read("gold_sketches"), AS_OF)


def delays_window(spark, sf_dir):
    """Percentiles of 30 days from the day sketches of the KPI layer."""
    return sketches.delays_window(logged_lake(spark, sf_dir).read("gold_sketches"), AS_OF)


# Reports and gates


def alert_freshness(spark, sf_dir):
    return checks.stale_layers(logged_lake(spark, sf_dir).log(), LATER)


def alert_consistency(spark, sf_dir):
    """Against a KPI table that stopped at an earlier state."""
    return checks.layer_mismatch(
        full(spark, sf_dir), full_gold(spark, sf_dir, CUT), AS_OF, days=30
    )


def alert_missing_dates(spark, sf_dir):
    return checks.missing_days(full(spark, sf_dir), LATER)


def alert_latency(spark, sf_dir):
    return checks.slow_days(full(spark, sf_dir), AS_OF, days=30)


def alert_rate_drop(spark, sf_dir):
    """With the clicks of the 20th and the conversions of the 27th left out."""
    rows = full(spark, sf_dir)
    silent = {"click": date(2024, 1, 20), "conversion": date(2024, 1, 27)}
    for flag, dark in silent.items():
        rows = rows.withColumn(flag, F.when(F.col("event_date") == F.lit(dark), 0).otherwise(F.col(flag)))
    return checks.rate_drops(changes.day_summaries(rows), AS_OF)


def ops_volume(spark, sf_dir):
    return checks.daily_volume(full(spark, sf_dir), AS_OF)


def ops_wow(spark, sf_dir):
    return checks.week_over_week(full(spark, sf_dir), AS_OF)


def ops_attribution(spark, sf_dir):
    return checks.attribution_coverage(full(spark, sf_dir), AS_OF)


def ops_latency(spark, sf_dir):
    return checks.latency_trend(full(spark, sf_dir), AS_OF)


def biz_kpi_trend(spark, sf_dir):
    return tidy(checks.kpi_trend(full_gold(spark, sf_dir), AS_OF))


def biz_conv_delay(spark, sf_dir):
    return checks.conversion_delays(full(spark, sf_dir), AS_OF)


def incident_day(spark, sf_dir):
    return checks.day_drilldown(full(spark, sf_dir), date(2024, 1, 22))


def incident_commits(spark, sf_dir):
    return checks.recent_commits(logged_lake(spark, sf_dir).log())


def infra_files(spark, sf_dir):
    """The file report after a compaction; bytes depend on the writer and are left out."""
    lake = _fragmented(spark, sf_dir)
    maintenance.compact_binpack(lake, AS_OF, now=run_time(LAST))
    lake.summarize(lake.days("silver"))
    return maintenance.report_files(lake).select(
        "event_date", "file_type", "file_count", "total_records"
    )


def infra_runs(spark, sf_dir):
    return checks.runs(logged_lake(spark, sf_dir).log())


def infra_retention(spark, sf_dir):
    return checks.commit_retention(logged_lake(spark, sf_dir).log())


def gate_silver_commit(spark, sf_dir):
    return checks.no_commit_today(logged_lake(spark, sf_dir).log(), "silver", LATER)


def gate_gold_commit(spark, sf_dir):
    return checks.no_commit_today(logged_lake(spark, sf_dir).log(), "gold", LATER)


def gate_silver_rows(spark, sf_dir):
    return checks.no_rows(full(spark, sf_dir), LATER)


def gate_consistency(spark, sf_dir):
    return checks.run_mismatch(
        full(spark, sf_dir), full_gold(spark, sf_dir, CUT), CUT + timedelta(days=1)
    )


def gate_bronze_present(spark, sf_dir):
    return checks.nothing_arrived(all_raw(spark, sf_dir), LATER)


def quality_profile(spark, sf_dir):
    return checks.quality_profile(full(spark, sf_dir))


# Wide rows


def numbered_wide(spark, sf_dir):
    return wide.number_rows(fixtures.wide_rows(spark, sf_dir), ["timestamp", "event_id"])


def split_wide_events(spark, sf_dir):
    return tidy(wide.split_wide_events(numbered_wide(spark, sf_dir), REAL_START, SPEED))


def first_conversion(spark, sf_dir):
    return wide.first_conversions(numbered_wide(spark, sf_dir)).select(
        "conversion_id", "row_index", "uid", "conversion_timestamp"
    )


def time_remap(spark, sf_dir):
    remapped = wide.time_remap(numbered_wide(spark, sf_dir), REAL_START, SPEED)
    return remapped.select("row_index", "timestamp", "real_ts")


def day_partition(spark, sf_dir):
    """Events stored by the day of their time, without a date among their own columns."""
    path = session_path(spark, "by-day")
    (
        fixtures.load(spark, sf_dir, "events")
        .select(
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("value").alias("amount"),
        )
        .withColumn("event_date", F.to_date("event_time"))
        .hint("rebalance", "event_date")
        .write.partitionBy("event_date")
        .parquet(path)
    )
    late = date(2024, 2, 1)
    # A row given by its values lands in the folder of its day like any other.
    spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit(f"{late} 10:30:00").cast("timestamp").alias("event_time"),
        F.lit("manual").alias("user_id"),
        F.lit(1.5).alias("amount"),
        F.lit(late).alias("event_date"),
    ).write.mode("append").partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def day_partition_range(spark, sf_dir):
    """Two days and a half of that table, asked for by time in SQL; other days are not read."""
    day_partition(spark, sf_dir).createOrReplaceTempView("events_by_day")
    time_function(spark, "events_between", "events_by_day", "event_time", "event_date")
    return spark.sql(
        "SELECT * FROM events_between(TIMESTAMP '2024-01-10 12:00:00', TIMESTAMP '2024-01-13 00:00:00')"
    )


# Maintenance and the daily run


def _fragmented(spark, sf_dir) -> Lake:
    """The row-level table written by several appends, so its days have several files."""
    lake = new_lake(spark)
    rows = full(spark, sf_dir)
    for part in range(3):
        lake.append("silver", rows.where(F.col("event_hour") % 3 == part))
    return lake


def compact_binpack(spark, sf_dir):
    lake = _fragmented(spark, sf_dir)
    maintenance.compact_binpack(lake, AS_OF, now=run_time(LAST))
    return tidy(lake.read("silver"))


def compact_zorder(spark, sf_dir):
    lake = _fragmented(spark, sf_dir)
    maintenance.compact_zorder(lake, AS_OF, now=run_time(LAST))
    return tidy(lake.read("silver"))


def compact_sort(spark, sf_dir):
    lake = _fragmented(spark, sf_dir)
    maintenance.compact_sorted(lake, AS_OF, now=run_time(LAST))
    return tidy(lake.read("silver"))


def campaign_filter(spark, sf_dir):
    """One campaign's rows and cost, read from files sorted by campaign."""
    lake = _fragmented(spark, sf_dir)
    maintenance.compact_sorted(lake, AS_OF, now=run_time(LAST))
    chosen = lake.read("silver").where(F.col("campaign") == 7)
    return tidy(
        chosen.groupBy("campaign").agg(
            F.count(F.lit(1)).alias("impressions"), F.sum("cost").alias("total_cost")
        )
    )


def daily_run(spark, sf_dir):
    """A backfill, then daily runs of the last dates with every gate; the resulting KPI table.

    The backfill must match events. A single day of a small table may have none to match. What
    arrived after the last day that has impressions is taken in without the gates, which ask
    every run date for rows.
    """
    lake, base = new_lake(spark), stored_raw(spark, sf_dir)
    first, last = raw_dates(spark, sf_dir)
    shown = stage1(spark, sf_dir).agg(F.max("event_date")).first()[0]
    backfilled = shown - timedelta(days=DAILY_RUNS)
    now = run_time(backfilled)
    silver.run_incremental(lake, base, first, backfilled, now=now)
    gold.run_range(lake, first, backfilled, now)
    for n in range(1, DAILY_RUNS + 1):
        run_date = backfilled + timedelta(days=n)
        daily.run(lake, base, run_date, run_date, run_time(run_date), require_match=False)
    if last > shown:
        late, now = shown + timedelta(days=1), run_time(last)
        silver.run_incremental(lake, base, late, last, now=now, require_match=False)
        gold.run_daily(lake, now)
    return tidy(lake.read("gold"))


_REGISTERED = (
    bronze_parse, bronze_quarantine, bronze_stream, bronze_runs, raw_range_scan, dedup_events,
    attribution_full, attribution_clicks, attribution_conversions, attribution_bucketed,
    attribution_orders,
    silver_stage1, silver_conform, silver_incremental, silver_full_refresh,
    silver_refresh_range, assert_matched,
    upsert_insert_absent, upsert_click, upsert_conversion, upsert_gold,
    update_where, delete_where,
    gold_kpi, gold_changed_only, gold_trailing_window, gold_range, gold_daily,
    gold_full_refresh, users_window, delays_window,
    changed_dates_count, changed_dates_initial, changed_dates_content, first_commit_of_day,
    alert_freshness, alert_consistency, alert_missing_dates, alert_latency, alert_rate_drop,
    ops_volume, ops_wow, ops_attribution, ops_latency,
    biz_kpi_trend, biz_conv_delay, incident_day, incident_commits,
    infra_files, infra_runs, infra_retention,
    gate_silver_commit, gate_silver_rows, gate_gold_commit, gate_consistency,
    gate_bronze_present, quality_profile,
    split_wide_events, first_conversion, time_remap, day_partition, day_partition_range,
    compact_binpack, compact_sort, compact_zorder, campaign_filter, daily_run,
)


def _in_utc(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {query.__name__: _in_utc(query) for query in _REGISTERED}
