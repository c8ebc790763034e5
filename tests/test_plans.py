"""Shapes of physical plans that decide how the operators scale."""

from helpers import DATA, seconds

from adlake.operators import attribution as at
from adlake.operators.changes import day_summaries
from adlake.plans import checks
from adlake.schemas import RAW
from adlake.sources.id_buckets import IdBuckets
from adlake.sources.raw import append_raw, read_raw
from adlake.workload import queries

SF = f"{DATA}/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_attribution_shuffles_each_side_once(spark):
    text = plan(queries.attribution_full(spark, SF))
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("WindowGroupLimit") == 6


def test_kpis_do_not_expand_rows(spark):
    text = plan(queries.gold_kpi(spark, SF))
    assert "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 5


def test_type_filter_and_columns_reach_the_scan(spark):
    text = plan(queries.raw(spark, SF, "click").select("eid", "timestamp"))
    assert "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text


def test_raw_reader_lists_the_asked_days_only(spark, events, tmp_path):
    t = seconds("2024-03-01 12:00:00")
    append_raw(events("click", ("a", t), ("b", t + 86400)), str(tmp_path), "click")
    one = read_raw(spark, str(tmp_path), "click", "2024-03-02", "2024-03-02")
    assert len(one.inputFiles()) == 1 and "raw_date=2024-03-02" in one.inputFiles()[0]
    assert [r["eid"] for r in one.collect()] == ["b"]
    assert one.columns == RAW["click"].names


def stored_silver(lake, events):
    t = seconds("2024-03-01 12:00:00")
    rows = events("impression", *((f"e{i}", t + i * 86400) for i in range(20)))
    lake.append("silver", at.silver_rows(rows))
    return lake.read("silver"), t


def test_batch_match_reads_candidate_days_only(lake, events):
    silver, t = stored_silver(lake, events)
    clicks = events("click", ("e3", t + 3 * 86400 + 5))
    near = silver.where(at.candidates(at.describe_batch(clicks), at.CLICK_WINDOW))
    matched = at.match_events(clicks, near, at.CLICK_WINDOW)
    text = plan(matched)
    scan = text[text.index("FileScan parquet") :]
    assert "event_date#" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_id,e3)" in scan
    assert "uid" not in scan.split("ReadSchema:")[1]
    assert near.select("_metadata.file_path").distinct().count() == 1
    assert matched.count() == 1


def test_stored_buckets_are_not_shuffled(spark, lake, events, tmp_path):
    """Only the batch is exchanged, once for its deduplication and the join."""
    silver, t = stored_silver(lake, events)
    stored = IdBuckets(spark, str(tmp_path / "buckets"), 4)
    stored.append(silver.where("event_id < 'e3'"))
    stored.append(silver.where("event_id >= 'e3'"))
    clicks = events("click", ("e3", t + 3 * 86400 + 5), ("e3", t + 3 * 86400 + 9), ("e7", t))
    matched = stored.match(clicks, at.CLICK_WINDOW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a batch too large to broadcast
    try:
        text = plan(stored.match(clicks, at.CLICK_WINDOW))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Bucketed: true" in text and text.count("Exchange") == 1
    assert [(r.event_id, r.match_delay_sec) for r in matched.collect()] == [("e3", 5)]
    stored.close()
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("id_buckets")]


def test_trailing_reports_prune_days(lake, events):
    silver, _ = stored_silver(lake, events)
    for report in (
        checks.daily_volume(silver, "2024-03-10"),
        checks.latency_trend(silver, "2024-03-10"),
        checks.slow_days(silver, "2024-03-10"),
        checks.no_rows(silver, "2024-03-10"),
    ):
        text = plan(report)
        assert "event_date#" in text.split("PartitionFilters:")[1].split("]")[0]


def test_day_summaries_read_few_columns(lake, events):
    silver, _ = stored_silver(lake, events)
    text = plan(day_summaries(silver))
    assert "ReadSchema: struct<click:int,conversion:int,updated_at:timestamp>" in text
    assert "partial_count" in text




def test_time_range_prunes_days(spark):
    text = plan(queries.day_partition_range(spark, SF))
    filters = text.split("PartitionFilters:")[1].split("DataFilters")[0]
    assert "event_date#" in filters
    days = queries.day_partition_range(spark, SF).select("event_date").distinct().count()
    assert days == 3
