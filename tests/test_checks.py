from datetime import date, timedelta, datetime

import pytest
from pyspark.sql import functions as F

from adlake import schemas
from adlake.operators import changes
from adlake.plans import checks

AS_OF = "2024-03-01"
YESTERDAY = "2024-02-29"


def silver(spark, *rows):
    """Rows of (date, click, conversion, latency, delay)."""
    frame = spark.createDataFrame(
        [(f"e{i}", *row) for i, row in enumerate(rows)],
        "event_id string, d string, click int, conversion int, latency bigint, delay bigint",
    )
    return frame.select(
        "event_id",
        F.to_date("d").alias("event_date"),
        F.concat(F.lit("u"), F.col("event_id")).alias("uid"),
        F.lit(1).alias("campaign"),
        "click",
        "conversion",
        F.col("delay").alias("conversion_delay_sec"),
        F.col("latency").alias("end_to_end_latency_sec"),
        F.lit(1).cast("bigint").alias("producer_to_broker_sec"),
        F.lit(2).cast("bigint").alias("broker_to_ingest_sec"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def day(text, count=1, latency=10):
    return [(text, 0, 0, latency, -1)] * count


def gold(spark, *rows):
    return spark.createDataFrame(list(rows), "d string, impressions bigint").select(
        F.to_date("d").alias("summary_date"), "impressions"
    )


def log(spark, *rows):
    """Rows of (layer, commit_id, time)."""
    full = [
        (layer, n, n - 1, datetime.fromisoformat(t), "append", 1)
        for layer, n, t in rows
    ]
    return spark.createDataFrame(full, schemas.RUN_LOG)


def test_freshness_includes_layers_that_never_committed(spark):
    commits = log(spark, ("silver", 1, "2024-03-01 00:00:00"))
    rows = checks.stale_layers(commits, AS_OF).collect()
    assert [(r["layer"], r["latest_committed_at"]) for r in rows] == [("gold", None)]
    assert checks.stale_layers(commits, "2024-03-02").count() == 2
    assert checks.no_commit_today(commits, "silver", AS_OF).count() == 0
    assert checks.no_commit_today(commits, "gold", AS_OF).count() == 1


def test_layer_mismatch_on_a_month_boundary(spark):
    stored = silver(spark, *day(YESTERDAY, 10))
    missing = checks.layer_mismatch(stored, gold(spark, ("2024-02-28", 10)), AS_OF).first()
    assert (missing["diff_pct"], missing["alert_type"]) == (100.0, "gold_partition_missing")
    assert missing["event_date"] == date(2024, 2, 29)
    apart = checks.layer_mismatch(stored, gold(spark, (YESTERDAY, 8)), AS_OF).first()
    assert (apart["diff_pct"], apart["alert_type"]) == (20.0, "silver_gold_count_mismatch")
    exactly_ten = gold(spark, (YESTERDAY, 9))
    assert checks.layer_mismatch(stored, exactly_ten, AS_OF).count() == 0


def test_empty_day_is_seen_by_the_row_gate_only(spark):
    nothing, summed = silver(spark, *day("2024-02-01")), gold(spark, (YESTERDAY, 5))
    assert checks.layer_mismatch(nothing, summed, AS_OF).count() == 0
    assert checks.run_mismatch(nothing, summed, YESTERDAY).count() == 0
    assert checks.no_rows(nothing, YESTERDAY).first()["silver_rows"] == 0
    both_empty = checks.run_mismatch(nothing, gold(spark, ("2024-02-01", 1)), YESTERDAY)
    assert tuple(both_empty.first()) == (0, 0, 100.0)


def test_missing_days(spark):
    stored = silver(spark, *day("2024-02-29"), *day("2024-02-27"), *day("2024-03-01"))
    missing = {r["missing_date"] for r in checks.missing_days(stored, AS_OF, 4).collect()}
    assert missing == {date(2024, 2, 26), date(2024, 2, 28)}
    assert checks.missing_days(stored, AS_OF).count() == 28


def test_latency_limit_is_exclusive(spark):
    assert checks.slow_days(silver(spark, *day(YESTERDAY, 3, 300)), AS_OF).count() == 0
    slow = checks.slow_days(silver(spark, *day(YESTERDAY, 3, 301)), AS_OF).first()
    assert slow["p50_e2e_sec"] == 301


def test_trailing_reports_leave_out_today(spark):
    stored = silver(spark, *day("2024-03-01"), *day("2024-02-16"), *day("2024-02-15"))
    days = [r["event_date"] for r in checks.daily_volume(stored, AS_OF).collect()]
    assert days == [date(2024, 2, 16)]
    assert [r["event_date"] for r in checks.latency_trend(stored, AS_OF).collect()] == days


def test_week_over_week(spark):
    stored = silver(spark, *day("2024-02-29", 3), *day("2024-02-22", 2), *day("2024-02-28", 1))
    rows = [tuple(r) for r in checks.week_over_week(stored, AS_OF).collect()]
    assert rows == [
        (date(2024, 2, 28), 1, None, None),
        (date(2024, 2, 29), 3, 2, 50.0),
    ]


def test_conversion_delays_skip_the_sentinel(spark):
    rows = [(YESTERDAY, 0, 1, 1, d) for d in (10, 20, 30, 40)] + [(YESTERDAY, 0, 1, 1, -1)]
    result = checks.conversion_delays(silver(spark, *rows), AS_OF).first()
    assert (result["p25_sec"], result["p50_sec"], result["conversion_count"]) == (10, 20, 4)
    none = checks.conversion_delays(silver(spark, *day(YESTERDAY)), AS_OF).first()
    assert (none["p50_sec"], none["conversion_count"]) == (None, 0)


def test_retention_counts_complete_days(spark):
    commits = log(
        spark, ("silver", 1, "2024-02-01 23:00:00"), ("silver", 2, "2024-02-03 01:00:00")
    )
    assert checks.commit_retention(commits).first()["retention_days"] == 1


def test_recent_commits_are_the_latest(spark):
    rows = [("silver", n, f"2024-02-{n:02d} 00:00:00") for n in range(1, 25)]
    found = [r["commit_id"] for r in checks.recent_commits(log(spark, *rows)).collect()]
    assert found == list(range(24, 4, -1))


def test_first_commit_of_day(spark):
    commits = log(
        spark,
        ("silver", 1, "2024-02-29 23:59:59"),
        ("silver", 2, "2024-03-01 00:00:00"),
        ("silver", 3, "2024-03-01 02:00:00"),
        ("gold", 9, "2024-03-01 00:00:00"),
    )
    first = changes.first_commit_of_day(commits, AS_OF).first()
    assert (first["commit_id"], first["parent_id"]) == (2, 1)
    assert changes.first_commit_of_day(commits, "2024-03-02").count() == 0


def test_removed_day_is_seen_by_content_only(spark):
    before = silver(spark, *day("2024-02-01"), *day("2024-02-02"))
    after = before.where("event_date = DATE '2024-02-01'")
    assert changes.changed_by_count(before, after).count() == 0
    assert [r[0] for r in changes.changed_by_content(before, after).collect()] == [
        date(2024, 2, 2)
    ]


def test_gate(spark):
    checks.gate(spark.range(0), "empty")
    with pytest.raises(checks.UnhealthyData, match="full: {'id': 0}"):
        checks.gate(spark.range(1), "full")


def test_quality_profile(spark):
    stored = silver(spark, (YESTERDAY, 2, 0, 1, -1), (YESTERDAY, 1, None, 1, -1))
    row = checks.quality_profile(stored.withColumn("campaign", F.lit(None))).first()
    assert (row["bad_click_flags"], row["bad_conversion_flags"]) == (1, 1)
    assert (row["null_keys"], row["null_campaigns"]) == (0, 2)


def test_gate_names_all_rows_but_shows_some(spark):
    with pytest.raises(checks.UnhealthyData, match="and more, 50 in all"):
        checks.gate(spark.range(50), "many")
    with pytest.raises(checks.UnhealthyData) as raised:
        checks.gate(spark.range(20), "few")
    assert "more" not in str(raised.value)


def test_gates_for_several_dates(spark):
    dates = [date(2024, 2, 28), date(2024, 2, 29)]
    stored = silver(spark, *day(YESTERDAY, 10))
    assert [r.run_date for r in checks.dates_without_rows(stored, dates).collect()] == dates[:1]
    raw = stored.select(F.col("event_date").alias("raw_date"))
    assert [r.run_date for r in checks.dates_without_raw(raw, dates).collect()] == dates[:1]
    apart = checks.dates_apart(stored, gold(spark, (YESTERDAY, 8)), dates).collect()
    assert sorted(tuple(r) for r in apart) == [(dates[0], 0, 0), (dates[1], 10, 8)]
    assert checks.dates_apart(stored, gold(spark, (YESTERDAY, 9)), dates[1:]).count() == 0


def test_stray_days(spark):
    days = spark.createDataFrame(
        [(date(1970, 1, 1), 3), (date(2024, 2, 29), 5), (date(2031, 1, 1), 1)],
        "event_date date, row_count bigint",
    )
    assert {r.row_count for r in checks.stray_days(days, AS_OF, 400).collect()} == {3, 1}


def test_sudden_falls_of_the_rate_alert(spark):
    """A day without clicks alerts; weekly rhythm, slow drift and young tables do not."""
    first = date(2024, 1, 1)

    def summaries(days, dark=()):
        rows = []
        for n in range(days):
            weekend = (first + timedelta(days=n)).weekday() >= 5
            clicks = 20 if weekend else 80 + n % 3
            rows.append((first + timedelta(days=n), 1000, 0 if n in dark else clicks, 0))
        return spark.createDataFrame(rows, "event_date date, row_count bigint, clicks bigint, conversions bigint")

    as_of = first + timedelta(days=50)
    assert checks.rate_drops(summaries(50), as_of).count() == 0
    found = checks.rate_drops(summaries(50, dark={45, 30}), as_of).collect()
    assert {(r.event_date, r.measure, r.rate_ppm, r.weeks) for r in found} == {
        (first + timedelta(days=n), "clicks", 0, 4) for n in (45, 30)
    }
    assert checks.rate_drops(summaries(13, dark={12}), first + timedelta(days=13)).count() == 0
    # Every row of the frame is one day: no plan sorts events.
    assert checks.rate_drops(summaries(0), as_of).count() == 0
